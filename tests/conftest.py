import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    s = local_session(4, shuffle_partitions=4, app="tidemark-tests")
    yield s


@pytest.fixture
def tiny_blocks(spark):
    """Tiny blocks/chunks so every halo and carry boundary is exercised."""
    old = {k: spark.conf.get(k, None) for k in ("tidemark.series.blockRows", "tidemark.series.chunkBars")}
    spark.conf.set("tidemark.series.blockRows", "64")
    spark.conf.set("tidemark.series.chunkBars", "37")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)
