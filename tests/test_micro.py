"""Micro cases K1-K18 of FIXTURES.md."""
import math

import pytest
from pyspark.sql import functions as F

from scorecraft.functions.exprs import cut, hist
from scorecraft.operators import association as C
from scorecraft.operators import binning as B
from scorecraft.operators import performance as E
from scorecraft.operators import prep as P
from scorecraft.operators import profile as A
from scorecraft.operators import stability as D
from scorecraft.operators import woe as W


def approx(a, b, tol=1e-6):
    return abs(a - b) <= tol


def test_k1_k2_contingency_woe(micro):
    ct = A.contingency(micro, {}, ["cat"], "y")
    got = {r["level"]: (r["n0"], r["n1"]) for r in ct.collect()}
    assert got == {"A": (4, 2), "B": (3, 4), "C": (1, 6)}
    w = {r["level"]: r["woe"] for r in W.woe_table(ct).collect()}
    assert approx(w["A"], 1.098612) and approx(w["B"], 0.117783) and approx(w["C"], -1.386294)
    iv = W.feature_iv(ct).first()["iv"]
    assert approx(iv, 0.890972)


def test_k3_quantile_edges_and_iv(micro):
    e = B.edges_dict(B.quantile_edges(micro, ["x"], 5))["x"]
    assert e == [1.0, 4.8, 8.6, 12.4, 16.2, 20.0]
    iv, _ = W.iv_report(micro, ["x"], [], "y", 5)
    assert approx(iv.first()["iv"], 0.592910)


def test_k4_k5_chi_square(micro):
    ct = A.contingency(micro, {}, ["cat"], "y")
    r = C.cramers_v(C.chi_square(ct)).first()
    assert approx(r["chi_square"], 3.730159) and r["dof"] == 2
    assert approx(r["p_value"], 0.154884) and approx(r["cramers_v"], 0.2928)
    ct2 = A.contingency(micro.withColumn("lo", (F.col("x") <= 10).cast("string")), {}, ["lo"], "y")
    r2 = C.cramers_v(C.chi_square(ct2)).first()
    assert approx(r2["chi_square"], 1.875) and r2["dof"] == 1
    assert approx(r2["p_value"], 0.170904, 1e-5) and approx(r2["cramers_v"], 0.2083)


def test_k6_forced_edges(spark):
    df1 = spark.createDataFrame([(float(i),) for i in range(1, 21)], "v double")
    assert B.edges_dict(B.forced_edges(df1, ["v"], 5))["v"] == [1.0, 4.8, 8.6, 12.4, 16.2, 20.0]
    df2 = spark.createDataFrame([(0.0,)] * 95 + [(10.0,), (20.0,), (30.0,), (40.0,), (9000.0,)], "v double")
    assert B.edges_dict(B.forced_edges(df2, ["v"], 5))["v"] == [0.0, 1.0, 9000.0]
    df3 = spark.createDataFrame([(0.0,)] * 50 + [(float(i),) for i in range(1, 51)], "v double")
    assert B.edges_dict(B.forced_edges(df3, ["v"], 5))["v"] == [0.0, 10.4, 30.2, 50.0]


def test_k7_ks(micro):
    assert approx(E.ks(micro, "s", "y").first()["ks"], 0.458333)


def test_k8_csi_numeric(spark):
    rows = [("Train", float(i)) for i in range(1, 21)] + [("Test", float(i)) for i in range(5, 25)]
    df = spark.createDataFrame(rows, "source string, x double")
    assert approx(D.csi_numeric(df, ["x"]).first()["csi"], 0.0131, 1e-4)


def test_k9_csi_categorical(spark):
    base = ["A"] * 6 + ["B"] * 7 + ["C"] * 7
    cur = ["A"] * 3 + ["B"] * 10 + ["D"] * 7
    df = spark.createDataFrame([("Train", v) for v in base] + [("Test", v) for v in cur], "source string, c string")
    assert approx(D.csi_categorical(df, ["c"]).first()["csi"], 0.1575, 1e-4)


def test_k10_risk_bands(micro):
    e = B.risk_band_edges(micro, "s", 5).first()["edges"]
    assert [round(v, 6) for v in e] == [0.05, 0.24, 0.43, 0.62, 0.81, 1.0]
    b = B.assign_risk_band(micro.withColumn("source", F.lit("Train")), e, "s")
    assert b.where(F.col("risk_band").isNull()).count() == 1
    t = {r["risk_band"]: r for r in D.band_table(b, "risk_band", "y", ["Train"]).collect()}
    assert [t[i]["Count"] for i in range(5)] == [3, 4, 4, 4, 4]
    assert [t[i]["Bads"] for i in range(5)] == [2, 2, 2, 1, 0]
    assert [t[i]["Gain"] for i in range(5)] == [28.5714, 57.1429, 85.7143, 100.0, 100.0]
    assert [round(t[i]["Lift"], 4) for i in range(5)] == [1.4286, 1.4286, 1.4286, 1.25, 1.0]


def test_k11_confusion_auc(micro):
    d = micro.withColumn("pred", E.hard_label("s"))
    cm = E.auc_hard(E.confusion_matrix(d, "y", "pred")).first()
    assert (cm["tn"], cm["fp"], cm["fn"], cm["tp"]) == (6, 2, 4, 8)
    assert approx(cm["auc"], 0.708333)


def test_k12_describe_vif(spark, micro):
    d = A.describe_numeric(micro, ["x"]).first()
    assert d["count"] == 20 and d["mean"] == 10.5 and d["std"] == 5.92
    assert d["p10"] == 2.9 and d["p50"] == 10.5 and d["p90"] == 18.1
    from scorecraft.operators.model import robust_scale, robust_scaler
    sc = robust_scaler(micro, ["x"])
    assert approx(robust_scale(micro.where("x = 1"), sc).first()["x"], -1.0)
    z = spark.createDataFrame([(float(i), float((7 * i) % 11)) for i in range(1, 21)], "x double, z double")
    v = {r["feature"]: r["vif"] for r in C.vif(z, ["x", "z"]).collect()}
    assert approx(v["x"], 1.003139) and approx(v["z"], 1.003139) and approx(v["const"], 7.607787)


def test_k13_woe_encoder(micro):
    t = {r["level"]: r["woe"] for r in W.woe_encoder_table(micro, ["cat"], "y").collect()}
    assert approx(t["A"], -0.847298) and approx(t["B"], -0.113329) and approx(t["C"], 0.916291)


def test_k14_cut_and_hist(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "v double")
    e = [0.0, 5.0, 10.0]
    assert [r[0] for r in df.select(cut("v", e, True)).collect()] == [0, 0, 1]
    assert [r[0] for r in df.select(cut("v", e, False)).collect()] == [None, 0, 1]
    assert [r[0] for r in df.select(hist("v", e)).collect()] == [0, 1, 1]


def test_k15_missing_share(spark):
    rows = [(None if i < 2 else 1.0, None if i < 5 else 1.0, 1.0) for i in range(10)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    m = {r["feature"]: r for r in A.missing_profile(df, ["a", "b", "c"]).collect()}
    assert [m[c]["missing_share"] for c in "abc"] == [0.2, 0.5, 0.0]
    assert [m[c]["missing_share_max"] for c in "abc"] == [0.4, 1.0, 0.0]


def test_k16_k17_k18(spark):
    df = spark.createDataFrame([(None,), ("Default",), ("Current",)], "s string")
    got = [r["yTarget"] for r in P.derive_target(df, "s", ["Default"]).collect()]
    assert got == ["level1", "Level0", "level1"]
    n = spark.createDataFrame([(0.0, -1.0, 0.0)], "a double, b double, c double")
    r = P.transform_numeric(n, {"a": "log", "b": "sqrt", "c": "recip"}).first()
    assert r["a"] is None and r["b"] is None and r["c"] == 0.0
    train = spark.createDataFrame([("x",), ("y",), ("z",)], "g string")
    m = P.category_map(train, "g", {"x": "X"})
    new = spark.createDataFrame([("x",), ("y",), ("w",)], "g string")
    assert sorted(r["g"] for r in P.group_categories(new, "g", m).collect()) == ["X", "missing", "y"]
