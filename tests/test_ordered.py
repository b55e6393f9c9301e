"""Exact quantiles and running totals against numpy, on both code paths."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from scorecraft.operators.ordered import quantiles, running_totals


@pytest.mark.parametrize("most,error", [(200_000, 0.0035), (20, 0.05), (5, 0.0001)])
def test_quantiles_match_numpy(spark, most, error):
    rng = np.random.default_rng(7)
    a = rng.normal(size=600).round(2)
    b = rng.integers(0, 9, size=600).astype(float)
    pdf = [(float(x), float(y), "g1" if i % 3 else "g2") for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(pdf, "a double, b double, g string")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    q = {(r["g"], r["feature"]): r["values"]
         for r in quantiles(df, ["a", "b"], probs, keys=["g"], most=most, error=error, k=200).collect()}
    for g in ("g1", "g2"):
        for c, arr in (("a", a), ("b", b)):
            sel = np.array([arr[i] for i in range(600) if (("g1" if i % 3 else "g2") == g)])
            assert np.allclose(q[(g, c)], np.quantile(sel, probs), atol=1e-9)


@pytest.mark.parametrize("parts", [None, 7])
def test_running_totals_in_parts(spark, parts):
    df = spark.range(0, 200).select((F.col("id") % 37).cast("double").alias("k"), F.lit(1).alias("c"),
                                    (F.col("id") % 2).alias("g"))
    rt = running_totals(df, ["g"], "k", ["c"], parts=parts).collect()
    for g in (0, 1):
        rows = sorted((r["k"], r["cum_c"], r["tot_c"]) for r in rt if r["g"] == g)
        ks = sorted(i % 37 for i in range(200) if i % 2 == g)
        exp = {}
        for k in ks:
            exp[k] = exp.get(k, 0) + 1
        cum = 0
        for k, c, t in rows:
            cum += exp[k]
            assert c == cum and t == len(ks)
