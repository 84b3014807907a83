"""Distributed exact quantiles equal numpy's linear interpolation, also when
one group dominates and is split over many range partitions."""

import numpy as np

from tidemark.operators.stats import exact_quantiles


def test_exact_quantiles_hot_group(spark):
    rng = np.random.default_rng(3)
    hot = rng.normal(size=3000)
    cold = rng.normal(size=7)
    rows = [("hot", float(x)) for x in hot] + [("cold", float(x)) for x in cold] + [("cold", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    out = {r.g: r for r in exact_quantiles(df, ["g"], "v", probs, partitions=16).collect()}
    for g, vals in (("hot", hot), ("cold", cold)):
        exp = np.quantile(vals, probs)
        got = [out[g][f"q{round(p * 100)}"] for p in probs]
        assert np.allclose(got, exp, rtol=1e-12, atol=1e-12), g
