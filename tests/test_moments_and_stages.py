"""Blocked moments, penalised logit, level lookups, pipeline stages and the neighbour index."""
import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from scorecraft.operators import association as C
from scorecraft.operators import binning as B
from scorecraft.operators import distcheck as DC
from scorecraft.operators import gram
from scorecraft.operators import model as M
from scorecraft.operators import prep as P
from scorecraft.operators.lookup import replace_levels
from scorecraft.operators.transformers import L1Logit, ScorecardBinner


@pytest.fixture(scope="module")
def holes(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(1e6, 1, (400, 4))
    x[:, 1] += x[:, 0] - 1e6
    x[:, 3] = 7.0
    x[rng.random((400, 4)) < 0.2] = np.nan
    rows = [tuple(None if np.isnan(v) and j % 2 else float(v) for j, v in enumerate(r)) for r in x]
    return x, spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5)


def test_correlation_over_rows_that_have_both(holes):
    x, df = holes
    got = {(r["feature1"], r["feature2"]): r["corr"] for r in C.correlation_matrix(df, list("abcd")).collect()}
    for i, a in enumerate("abcd"):
        for j, b in enumerate("abcd"):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if a == b:
                assert got[a, b] == 1.0
            elif "d" in (a, b):
                assert got[a, b] is None  # a constant
            else:
                assert got[a, b] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)


def test_moments_of_complete_rows(holes):
    x, df = holes
    n, mean, cov = gram.complete_moments(df, list("abc"))
    whole = x[~np.isnan(x[:, :3]).any(1), :3]
    assert n == len(whole) and np.allclose(mean, whole.mean(0)) and np.allclose(cov, np.cov(whole.T), atol=1e-8)


def test_two_hundred_columns(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 200))
    df = spark.createDataFrame(x.tolist(), [f"c{i}" for i in range(200)])
    r = gram.pairwise_correlation(df, df.columns)
    assert np.allclose(r, np.corrcoef(x.T))


@pytest.mark.parametrize("alpha", [0.0, 0.8, 5.0, 40.0, 1e4])
@pytest.mark.parametrize("constant", [True, False])
def test_penalised_logit_is_stationary(spark, alpha, constant):
    rng = np.random.default_rng(int(alpha) + constant)
    x = np.column_stack([rng.normal(size=(500, 3)), rng.random((500, 3)) < [0.1, 0.5, 0.9]])
    y = (rng.random(500) < 1 / (1 + np.exp(-(x @ [1, 0, -0.5, 2, 0, 1] - 1)))).astype(float)
    rows = spark.createDataFrame([(r.tolist(), float(t)) for r, t in zip(x, y)], "x array<double>, y double").repartition(3)
    beta, miss = gram.l1_logit(rows, 6, alpha, constant)
    z = np.column_stack([np.ones(500), x])
    gradient = z.T @ (1 / (1 + np.exp(-z @ beta)) - y)
    weight = np.r_[alpha if constant else 0.0, np.full(6, alpha)]
    assert miss < 1e-2 and gram.stationarity(gradient, beta, weight) == pytest.approx(miss, abs=1e-6)
    assert (np.abs(gradient[beta == 0]) <= weight[beta == 0] + 1e-2).all()
    if alpha >= 1e4:
        assert (beta[1:] == 0).all()


def test_penalised_logit_equals_spark_without_the_constant(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(600, 3))
    y = (rng.random(600) < 1 / (1 + np.exp(-x @ [1, -1, 0]))).astype(float)
    df = spark.createDataFrame([(r.tolist(), float(t)) for r, t in zip(x, y)], "x array<double>, y double")
    df = df.withColumn("features", M.array_to_vector("x"))
    theirs = M.logistic("l1", alpha=10.0, n_rows=600, max_iter=500).setTol(1e-10).fit(df)
    ours = L1Logit(alpha=10.0, penaliseConstant=False).fit(df)
    assert np.allclose(ours.coefficients.toArray(), theirs.coefficients.toArray(), atol=1e-3)
    assert ours.intercept == pytest.approx(theirs.intercept, abs=1e-3)


@pytest.mark.parametrize("in_plan,broadcast", [(100, 100), (0, 100), (0, 0)])
def test_levels_are_replaced_alike_on_every_path(spark, in_plan, broadcast):
    rows = [("a" if i % 3 else "hot", None if i % 7 == 0 else f"k{i % 5}", i) for i in range(300)]
    df = spark.createDataFrame(rows, "u string, v string, i int").repartition(4)
    table = spark.createDataFrame([("u", "hot", 1.5), ("u", "b", 9.0), ("v", "k1", 2.0), ("v", "missing", -1.0), ("w", "a", 5.0)],
                                  "feature string, level string, woe double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = replace_levels(df, table, ["u", "v"], "woe", 0.0, "missing", in_plan, broadcast)
        plan = got._jdf.queryExecution().toString()
        found = {r["i"]: (r["u"], r["v"]) for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == {i: ({"hot": 1.5}.get(u, 0.0), {"k1": 2.0, None: -1.0}.get(v, 0.0)) for u, v, i in rows}
    assert got.columns == df.columns
    if broadcast or in_plan:  # rows do not move by level
        assert "hashpartitioning(u" not in plan and "hashpartitioning(coalesce" not in plan


@pytest.fixture(scope="module")
def loans(spark):
    rng = np.random.default_rng(5)
    rows = [(float(rng.normal()), float(rng.integers(0, 40)), int(i % 2), "abc"[i % 3], float(rng.random() < 0.3)) for i in range(600)]
    return spark.createDataFrame(rows, "x double, z double, flag int, c string, y double")


@pytest.mark.parametrize("kw", [{}, {"method": "monotonic"}, {"binned": False}, {"penalise_constant": True},
                                {"groups": {"c": {"a": "ab", "b": "ab"}}, "transforms": {"z": "sqrt"}, "custom_edges": {"x": [-9, 0, 9]}}])
def test_a_saved_pipeline_holds_its_binning(spark, loans, tmp_path, kw):
    card = M.build_scorecard(loans, ["x", "z", "flag"], ["c"], **kw)
    card.pipeline.save(f"{tmp_path}/p")
    again = PipelineModel.load(f"{tmp_path}/p")
    odd = loans.limit(3).select(F.lit(None).cast("double").alias("x"), F.lit(1e9).alias("z"), F.lit(5).alias("flag"),
                                F.lit("new").alias("c"), "y")
    rows = loans.unionByName(odd)
    one, two = (M.score(p, rows).select(*[F.col(c).cast("string") for c in loans.columns], "p", "pred").collect() for p in (card.pipeline, again))
    assert sorted(map(tuple, one), key=str) == sorted(map(tuple, two), key=str) and len(one) == 603
    assert all(r["p"] is not None for r in one)
    if kw.get("penalise_constant"):
        assert len(M.lr_stage(card).coefficients) == len(card.names)


def test_an_estimator_round_trip(loans, tmp_path):
    est = ScorecardBinner(numeric=["x", "z"], categorical=["c"], bins=3)
    est.save(f"{tmp_path}/e")
    a, b = est.fit(loans), ScorecardBinner.load(f"{tmp_path}/e").fit(loans)
    assert a.edges == b.edges and set(a.edges) == {"x", "z"} and all(len(e) == 4 for e in a.edges.values())


def test_counts_near_a_cut_are_exact(spark):
    df = spark.range(2000).select(*[(F.col("id") % k).cast("string").alias(f"c{k}") for k in (3, 14, 15, 16, 17, 900)],
                                  F.when(F.col("id") % 6 > 0, F.col("id") % 6).cast("double").alias("five"),
                                  (F.col("id") % 5).cast("double").alias("zeros"), F.col("id").cast("double").alias("many"))
    assert P.high_cardinality(df, [c for c in df.columns if c[0] == "c"], 15) == ["c16", "c17", "c900"]
    got = {r["feature"]: r for r in B.low_cardinality_levels(df, ["five", "zeros", "many"], 5).collect()}
    assert got["five"]["n_distinct"] == 6 and not got["five"]["low_cardinality"] and not got["many"]["low_cardinality"]
    assert got["zeros"]["levels"] == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_neighbour_index_recall(spark):
    rng = np.random.default_rng(4)
    p = np.round(np.r_[rng.normal(size=(3000, 5)), np.zeros((800, 5))], 2)
    t = (p[:, 0] + rng.normal(size=len(p)) * 0.3 > 0).astype(float)
    q = np.round(rng.normal(size=(400, 5)), 2)
    frame = lambda x, y: spark.createDataFrame([(r.tolist(), float(v)) for r, v in zip(x, y)], "x array<double>, origin double").repartition(4)
    got = DC.nearest_neighbours(frame(p, t), frame(q, np.arange(len(q))), 3, cell_rows=150, block=300).collect()
    assert len(got) == len(q)
    near = np.argsort(((q[:, None] - p[None]) ** 2).sum(2), 1, kind="stable")[:, :3]
    right = sum(r["pred"] == int(t[near[int(r["origin"])]].mean() > 0.5) for r in got)
    assert right >= 0.9 * len(q)


def test_neighbour_cells_stay_small_where_rows_are_dense(spark, monkeypatch):
    rng = np.random.default_rng(8)
    p = np.r_[rng.normal(0, 1, (4000, 3)), rng.normal(0, 1000, (600, 3))]  # far rows draw most first centres
    t = (p[:, 0] > 0.2).astype(int)
    q = rng.normal(0, 1, (300, 3))
    frame = lambda x, o: spark.createDataFrame([(r.tolist(), float(v)) for r, v in zip(x, o)], "x array<double>, origin double")
    kept, save = {}, DC.save_stage

    def keep(rows, name):
        kept[name] = save(rows, name)
        return kept[name]

    monkeypatch.setattr(DC, "save_stage", keep)
    got = DC.nearest_neighbours(frame(p, t), frame(q, np.arange(len(q))), 3, cell_rows=100, block=200).collect()
    held = [r["count"] for r in kept["neighbour_cells"].groupBy("cell").count().collect()]
    assert sum(held) == len(p) and max(held) <= 200
    near = np.argsort(((q[:, None] - p[None]) ** 2).sum(2), 1, kind="stable")[:, :3]
    right = sum(r["pred"] == int(t[near[int(r["origin"])]].mean() > 0.5) for r in got)
    assert len(got) == len(q) and right >= 0.95 * len(q)


def test_svd_is_not_centred(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(3, 1, (200, 4))
    rows = spark.createDataFrame([(r.tolist(), 0.0) for r in x], "a array<double>, origin double").select(M.array_to_vector("a").alias("raw"), "origin")
    v = DC.svd_components(rows, 2)
    _, _, want = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(np.abs(v.T @ want[:2].T), np.eye(2), atol=1e-6)
    got = np.array([r["x"] for r in DC._projected(rows, v).collect()])
    assert np.allclose(np.sort(np.abs(got[:, 0])), np.sort(np.abs(x @ want[0])), atol=1e-6)
