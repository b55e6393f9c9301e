"""Fits that share their passes, and the view that the fits read once."""
import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from scorecraft.operators import model as M


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 4))
    y = (rng.random(600) < 1 / (1 + np.exp(-(1.5 * x[:, 0] - x[:, 2])))).astype(float)
    rows = [([float(a) for a in r], float(t)) for r, t in zip(x, y)]
    v = spark.createDataFrame(rows, "a array<double>, y double").select(array_to_vector("a").alias("features"), "y")
    return v.persist()


@pytest.mark.parametrize("l2, l1", [(1.0, 0.0), (0.0, 20.0)])
def test_shared_fit_agrees_with_spark(frame, l2, l1):
    n = frame.count()
    rows = M._plain(frame, "y", F.lit(0))
    got = M.fit_logits(rows, [([0, 1, 2, 3], -1, l2, l1), ([2, 0], -1, l2, l1)])
    want = LogisticRegression(labelCol="y", regParam=(l2 + l1) / n, elasticNetParam=l1 / (l1 + l2), standardization=False, tol=1e-10,
                              maxIter=200).fit(frame)
    assert np.allclose(got[0], [want.intercept, *want.coefficients.toArray()], atol=1e-4)
    assert got[1, 2] == got[1, 4] == 0 and got[1, 1] > 0 > got[1, 3]
    warm = M.fit_logits(rows, [([0, 1, 2, 3], -1, l2, l1)], start=got[1:])
    assert np.allclose(warm[0], got[0], atol=1e-5)


def _passes(monkeypatch, run):
    seen, summed = [], M.summed

    def counted(rows, fn, width):
        seen.append(width)
        return summed(rows, fn, width)

    monkeypatch.setattr(M, "summed", counted)
    return run(), len(seen)


def test_random_search_shares_passes_and_has_exact_areas(frame, monkeypatch):
    found, passes = _passes(monkeypatch, lambda: M.random_search(frame, draws=6, folds=3))
    assert len(found) == 6 and 0 < passes < 40  # not one fit a draw and fold
    penalty, c, auc = found[0]
    v = M.with_folds(frame, 3)
    areas = []
    for k in range(3):
        m = M.logistic(penalty, C=c, n_rows=v.where(F.col("_fold") != k).count()).fit(v.where(F.col("_fold") != k))
        got = [(r["p"], r["y"]) for r in M.score(m, v.where(F.col("_fold") == k)).select("p", "y").collect()]
        pos, neg = ([p for p, y in got if y == t] for t in (1, 0))
        areas.append(np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg]))
    assert abs(auc - np.mean(areas)) < 1e-3


def test_rfe_and_selection_take_few_passes(frame, monkeypatch):
    assert sorted(M.rfe(frame, list("abcd"), 2)) == ["a", "c"]
    got, passes = _passes(monkeypatch, lambda: M.sequential_select(frame, list("abcd"), 2, "backward", folds=3))
    assert len(got) == 2 and passes < 40


def test_levels_of_all_columns_come_from_one_indexer(spark):
    d = spark.createDataFrame([("x", "q"), ("w", "q"), ("x", "r")], "a string, b string")
    stages = M.one_hot_stages(["a", "b"])
    assert sum(type(s).__name__ == "StringIndexer" for s in stages) == 1
    from pyspark.ml import Pipeline
    assert M.one_hot_names(Pipeline(stages=stages).fit(d), ["a", "b"]) == ["a_w", "a_x", "b_q", "b_r"]


def test_fits_read_a_stage_table_and_not_the_joins(spark, tmp_path):
    from scorecraft.plans import registry as R
    ts = "timestamp_ntz'1998-01-01'"
    spark.sql(f"""SELECT id AS l_orderkey, id AS l_partkey, 1 AS l_linenumber, {ts} AS l_shipdate, 1.0D AS l_quantity, 2.0D AS l_extendedprice,
              0.1D AS l_discount, 0.0D AS l_tax, 'O' AS l_linestatus FROM range(8)""").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("SELECT id AS o_orderkey, id % 2 AS o_custkey, 5.0D AS o_totalprice, 'low' AS o_orderpriority FROM range(8)").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT id AS p_partkey, 'PROMO' AS p_type, 3 AS p_size, 'b' AS p_brand FROM range(8)").write.parquet(f"{tmp_path}/part.parquet")
    spark.sql("SELECT id AS c_custkey, 'm' AS c_mktsegment FROM range(2)").write.parquet(f"{tmp_path}/customer.parquet")
    staged = R.staged_train(spark, str(tmp_path))
    assert "Join" not in staged._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(staged.collect()) == sorted(R.train(spark, str(tmp_path)).collect())


def test_standard_errors_do_not_hang_on_the_order_of_rows(spark):
    rng = np.random.default_rng(3)
    hot = np.column_stack([np.eye(3)[rng.integers(0, 3, 400)], np.eye(2)[rng.integers(0, 2, 400)]])  # levels add up to the constant
    y = (rng.random(400) < 0.3 + 0.4 * hot[:, 0]).astype(float)
    d = spark.createDataFrame([([float(a) for a in r], float(t), float(p)) for r, t, p in zip(hot, y, 0.2 + 0.3 * hot[:, 0])],
                              "a array<double>, y double, p double").select(array_to_vector("a").alias("features"), "y", "p")

    class Fitted:
        intercept, coefficients = 0.1, type("C", (), {"toArray": staticmethod(lambda: np.array([0.5, -0.2, 0.3, 0.4, -0.1]))})

    found = [[r["std_err"] for r in M.inference_table(spark, x, Fitted, list("abcde")).collect()][:6] for x in (d.coalesce(1), d.repartition(7))]
    x = np.column_stack([np.ones(400), hot])
    w = (0.2 + 0.3 * hot[:, 0]) * (0.8 - 0.3 * hot[:, 0])
    want = np.sqrt(np.diag(np.linalg.pinv((x * w[:, None]).T @ x, rcond=1e-10)))
    assert np.allclose(found, [want, want], rtol=1e-6)
