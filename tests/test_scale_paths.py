"""Paths that only large or odd inputs take: many buckets with and without keys,
a value with a third of all rows, no feature, missing roles, high degrees of freedom."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorecraft.functions.exprs import chi2_sf
from scorecraft.operators.ordered import quantiles, running_totals
from scorecraft.operators.performance import ks
from scorecraft.operators.profile import contingency
from scorecraft.operators.woe import iv_by_source


@pytest.mark.parametrize("keys", [[], ["g"]])
@pytest.mark.parametrize("parts", [1, 16])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_in_many_buckets(spark, keys, parts, descending):
    rows = [(float(0 if i % 3 == 0 else i % 50), i % 2) for i in range(300)]  # 0.0 holds a third
    df = spark.createDataFrame(rows, "k double, g int").withColumn("c", F.lit(1)).repartition(parts)
    got = running_totals(df, keys, "k", ["c"], parts=9, descending=descending).collect()
    for g in {r["g"] for r in got} if keys else [None]:
        mine = [k for k, h in rows if g is None or h == g]
        for r in got:
            if g is None or r["g"] == g:
                want = sum(k >= r["k"] if descending else k <= r["k"] for k in mine)
                assert (r["cum_c"], r["tot_c"]) == (want, len(mine))


def test_quantiles_with_a_hot_value(spark):
    x = np.r_[np.zeros(100), np.random.default_rng(1).normal(size=200)]
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(16)
    got = quantiles(df, ["x"], [0.0, 0.1, 0.5, 0.99, 1.0], most=9, error=0.05, k=200).first()["values"]
    assert np.allclose(got, np.quantile(x, [0.0, 0.1, 0.5, 0.99, 1.0]))


def test_ks_without_keys_in_buckets(spark):
    rows = [(i / 40, int(i % 7 > 3)) for i in range(40)] * 3
    df = spark.createDataFrame(rows, "score double, y int")
    assert ks(df, parts=5).first()["ks"] == pytest.approx(ks(df).first()["ks"])


def test_contingency_without_features(spark):
    df = spark.createDataFrame([("Train", 1.0)], "source string, y double")
    out = contingency(df, keys=["source"])
    assert out.columns == ["source", "feature", "bin", "level", "n", "n1", "n0"] and out.count() == 0


def test_iv_by_source_with_a_role_missing(spark):
    perf = spark.createDataFrame([("Test", "f", 0.1), ("Test", "f", 0.2), ("Train", "f", 0.4)], "source string, feature string, IV double")
    assert [r.asDict() for r in iv_by_source(perf).collect()] == [{"feature": "f", "IV_Test": 0.3}]


def test_chi_square_tail_at_high_dof(spark):
    def tail(x, k):  # an independent form: the regularised lower series of the gamma integral
        a, h = k / 2, x / 2
        term = math.exp(a * math.log(h) - h - math.lgamma(a + 1))
        total, n = 0.0, 0
        while term > 1e-18 or n < h:
            total += term
            n += 1
            term *= h / (a + n)
        return 1 - total
    rows = [(float(k * f), k) for k in (1, 2, 3, 4, 7, 30, 399, 400, 1599, 1600, 4001) for f in (0.9, 1.0, 1.1)]
    for r in spark.createDataFrame(rows, "x double, dof int").withColumn("p", chi2_sf("x", "dof")).collect():
        assert r["p"] == pytest.approx(tail(r["x"], r["dof"]), abs=2e-7), r
