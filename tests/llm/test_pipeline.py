import subprocess
import sys

import corpus_pipeline as pipeline
from pyspark.sql import functions as F
from tidemark.llm import op2_simhash, op3_lines, op5_quality, op7_decontaminate
from tidemark.llm.common import materialize, table


def test_stages(spark):
    from tests.conftest import SF

    docs = table(spark, SF, "documents")
    columns, seen = docs.columns, {}
    for name, stage in pipeline.STAGES:
        seen[name] = (docs, docs := materialize(stage(spark, docs, SF), name))
    for name, (before, after) in list(seen.items())[:-1]:
        assert after.columns == columns and 0 < after.count() <= before.count(), name
    before, after = seen["quality"]
    labels = table(spark, SF, "labels")
    assert after.join(labels.where("toxic = 1 OR quality = 0"), "doc_id").count() == 0
    assert before.join(labels.where("toxic = 0 AND quality = 1"), "doc_id").join(after, "doc_id", "left_anti").count() == 0
    before, after = seen["lines"]
    assert op3_lines.removed_lines(after).count() == 0 and after.count() == before.count()
    before, after = seen["near_duplicates"]
    groups = op2_simhash.simhash_components(before)
    assert after.count() == groups.select("component_id").distinct().count()
    assert {r.doc_id for r in after.collect()} == {r.component_id for r in groups.collect()}
    before, after = seen["decontamination"]
    bad = {r.doc_id for r in op7_decontaminate.containment_pairs(before, table(spark, SF, "benchmark")).collect()}
    assert {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} == bad and bad
    before, after = seen["mix"]
    assert after.select("doc_id").distinct().count() <= before.count() and after.columns[:5] == columns


def test_stages_take_odd_tables(spark, odd_docs, no_docs):
    from tests.conftest import SF

    for docs in (odd_docs.drop("mix_epoch"), no_docs.drop("mix_epoch")):
        columns = docs.columns
        for name, stage in pipeline.STAGES:
            docs = materialize(stage(spark, docs, SF), name)
            assert docs.columns[:len(columns)] == columns


def test_entry_without_the_subpackage(tmp_path):
    """The other queries stay when the llm folders and the pipeline are gone."""
    import shutil

    repo = pipeline.__file__.rsplit("/", 1)[0]
    shutil.copy(f"{repo}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{repo}/tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and not any(k.startswith('op1') for k in q) and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
