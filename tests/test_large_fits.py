"""Fits and checks that pass over large tables: the same results from cheaper passes."""
import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from scorecraft.functions.exprs import EDGE_DP
from scorecraft.operators import areas as A
from scorecraft.operators import binning as B
from scorecraft.operators import distcheck as DC
from scorecraft.operators import model as M
from scorecraft.operators import ordered as O


def test_grid_sums_hold_what_an_expression_per_row_would(spark):
    rng = np.random.default_rng(2)
    x = [None, math.nan, 0.1 + 0.2, 0.3, 0.3000000004, 0.3000000006, -5.0, 99.0, *map(float, rng.normal(size=300))]
    rows = [(v, v and -v, None if i % 17 == 3 else float(i % 2)) for i, v in enumerate(x)]
    d = spark.createDataFrame(rows, "x double, z double, y double")
    grid = [-1.0, -0.25, 0.3, 0.300000001, 0.8, 2.0]
    got = B.grid_sums(d.repartition(3), {"x": grid, "z": [0.0]}, "y")
    v = F.round("x", EDGE_DP)  # edges are held at this precision
    cell = F.greatest(F.size(F.filter(F.array(*map(F.lit, grid)), lambda e: e < v)) - 1, F.lit(0))
    want = {r["cell"]: r for r in d.where("x IS NOT NULL AND y IS NOT NULL").groupBy(cell.alias("cell")).agg(
        F.count("*").alias("n"), F.sum(v).alias("sx"), F.sum("y").alias("sy")).collect()}
    assert [(c, n, sy) for c, n, _, sy in got["x"]] == [(c, want[c]["n"], want[c]["sy"]) for c in sorted(want)]
    assert np.allclose([c[2] for c in got["x"]], [want[c]["sx"] for c in sorted(want)], equal_nan=True)
    assert [c[:2] for c in got["z"]] == [(0, sum(r["n"] for r in want.values()))]
    assert B.grid_sums(d, {}, "y") == {}


def test_monotonic_edges_sum_their_cells_in_one_pass(spark, monkeypatch):
    seen, summed = [], B.summed
    monkeypatch.setattr(B, "summed", lambda *a: seen.append(a) or summed(*a))
    d = spark.range(400).selectExpr("CAST(id AS DOUBLE) AS x", "CAST(id % 7 AS DOUBLE) AS z", "CAST(id > 200 AS INT) AS y")
    found = {r["feature"]: r for r in B.monotonic_edges(d, ["x", "z"]).collect()}
    assert len(seen) == 1 and found["x"]["bins"] == 3  # four would tie


def test_quantiles_hold_rows_only_where_reading_again_runs_more_than_a_scan(spark, tmp_path):
    spark.range(50).selectExpr("CAST(id AS DOUBLE) AS x", "id % 3 AS k").write.parquet(f"{tmp_path}/t")
    d = spark.read.parquet(f"{tmp_path}/t")
    assert O.reads_files(d.where("k < 2").select((F.col("x") + 1).alias("x")))
    assert not O.reads_files(d.join(d.groupBy("k").count(), "k")) and not O.reads_files(d.distinct()) and not O.reads_files(d.repartition(3))
    assert O.quantiles(d, ["x"], [0.5]).first()["values"] == [24.5]


def test_scores_are_packed_without_loss():
    for v in ([0.5], [-2.0, -2.0, 0.0, 1e-10, 3.25], [0.1, 0.1000000001], [-1e9, 0.0, 7e8, 7e8], [-400.0, 400.0]):
        v = np.round(np.array(v), A.SCORE_DP)
        values, counts = A.unpacked(*A.packed(v))
        assert np.repeat(values, counts).tolist() == v.tolist()
    assert len(A.packed(np.array([0.1, 0.2, 0.3]))[2]) == 12  # four bytes a score


@pytest.mark.parametrize("few, held", [(10**9, 10**9), (20, 300)])  # one bucket in one piece; many of both
def test_areas_count_pairs_and_half_of_ties(spark, few, held):
    rng = np.random.default_rng(8)
    z, y, fold = np.round(rng.normal(size=(500, 3)), 1), rng.random(500) < 0.3, rng.integers(0, 2, 500)
    z[:, 1] = 0.25  # a model that tells nothing apart
    y[fold == 1] &= z[fold == 1, 0] > 9  # a fold without positives
    d = spark.createDataFrame([([*map(float, a)], float(t), int(f)) for a, t, f in zip(z, y, fold)], "x array<double>, y double, _fold int")

    def scores(b):
        return (np.array(b.column("x").to_pylist()), b.column("y").to_numpy() == 1, b.column("_fold").to_numpy())

    got = A.roc_areas(d.repartition(5), scores, 2, few=few, held=held)
    for m in range(3):
        for f in range(2):
            pos, neg = z[(fold == f) & y, m], z[(fold == f) & ~y, m]
            want = sum((a > neg).sum() + 0.5 * (a == neg).sum() for a in pos)
            assert got[m * 2 + f] == (want, len(pos), len(neg))


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3))
    y = (rng.random(300) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    return spark.createDataFrame([([*map(float, r)], float(t)) for r, t in zip(x, y)], "a array<double>, y double").select(
        array_to_vector("a").alias("features"), "y")


@pytest.mark.parametrize("search", [lambda v: M.random_search(v, draws=2, folds=2), lambda v: M.rfe(v, list("abc"), 1),
                                    lambda v: M.sequential_select(v, list("abc"), 2, "backward", folds=2)])
def test_passes_read_a_stage_table_and_no_cache(fitted, monkeypatch, search):
    plans, fit = [], M.fit_logits

    def seen(rows, *a, **kw):
        plans.append(rows._jdf.queryExecution().withCachedData().toString())
        return fit(rows, *a, **kw)

    monkeypatch.setattr(M, "fit_logits", seen)
    assert search(fitted)
    assert plans and all("InMemoryRelation" not in p and "parquet" in p for p in plans)


@pytest.mark.parametrize("many", [1, 4])
def test_cells_are_found_as_by_following_each_row(many):
    rng = np.random.default_rng(4)
    tree, inner = DC._Cells(rng.normal(size=(7, 3))), []
    for cell, parts in ((2, 3), (5, 2), (0, 9)):  # cut into as many as fill a power of two, or not
        inner.append(tree.size)
        tree.cut(cell, rng.normal(size=(parts, 3)))
    tree.close()
    tree.cut(inner[2] + 4, rng.normal(size=(5, 3)))  # a part of a part
    tree.close()
    x = rng.normal(size=(700, 3))

    def near(row, at):
        d = (tree.centres[at] ** 2).sum(1) - 2 * tree.centres[at] @ row
        return sorted(zip(d, range(len(d))))[:many]

    def followed(row):
        out, open_ = [], [(d, c) for d, c in near(row, 0)]
        while open_:
            d, c = open_.pop()
            if c in tree.cuts:
                first, at = tree.cuts[c]
                open_ += [(e, first + i) for e, i in near(row, at)]
            else:
                out.append((d, c))
        return [c for _, c in sorted(out)[:many]]

    row, cell = tree.find(x, many)
    assert [cell[row == i].tolist() for i in range(len(x))] == [followed(r) for r in x]
    if many == 1:
        root = tree.roots(x, 1)[0][:, 0]
        assert tree.find(x, 1, root)[1].tolist() == cell.tolist()
