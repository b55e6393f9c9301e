"""Distribution check by adversarial validation.

Rows of two sets are labelled by origin, split 70/30, preprocessed (median
impute + robust scale + one-hot), reduced by a truncated SVD, classified, and scored with the hard-label AUC: an AUC well
above 0.5 means the sets can be told apart.

Classifiers: Gaussian naive Bayes (``NaiveBayes(modelType='gaussian')``),
LDA / QDA (class means and covariances from one blocked pass), and k nearest
neighbours over an index that holds every training row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.io import save_stage
from .gram import class_moments, matrix
from .model import one_hot_stages, robust_scale, robust_scaler
from .performance import auc_hard, confusion_matrix


def svd_components(rows: DataFrame, k: int, features: str = "raw") -> np.ndarray:
    """(dims x k) right singular vectors of the rows, not centred, largest first: a
    truncated SVD of the sparse one-hot matrix, whose products are summed where the rows are."""
    from pyspark.mllib.linalg.distributed import RowMatrix
    from pyspark.mllib.util import MLUtils

    found = RowMatrix(MLUtils.convertVectorColumnsFromML(rows.select(features), features)).computeSVD(k)
    v = found.V.toArray()
    return v * np.where(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])] < 0, -1.0, 1.0)  # the sign is free: largest part positive


def _projected(rows: DataFrame, v: np.ndarray) -> DataFrame:
    """(x array<double>, origin): every row's coordinates along the columns of ``v``."""

    def run(batches):
        for b in batches:
            got = matrix(b) @ v
            ends = pa.array(np.arange(0, got.size + 1, v.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, pa.array(got.ravel())), b.column("origin")], ["x", "origin"])

    return rows.select(vector_to_array("raw").alias("x"), "origin").mapInArrow(run, "x array<double>, origin double")


def _prepare(a: DataFrame, b: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
             seed: int, svd_k: int | None):
    cols = [*numeric, *categorical]
    d = (a.select(*cols).withColumn("origin", F.lit(0.0))
         .unionByName(b.select(*cols).withColumn("origin", F.lit(1.0))))
    d = d.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("missing")) for c in categorical})
    # by content, so that a recomputed or retried task deals every row alike; equal rows go together
    d = d.withColumn("_r", F.pmod(F.xxhash64(*cols, F.lit(seed)), F.lit(1000)))
    tr, te = d.where(F.col("_r") < 700), d.where(F.col("_r") >= 700)
    sc = robust_scaler(tr, numeric)
    tr, te = robust_scale(tr, sc), robust_scale(te, sc)
    pm = Pipeline(stages=one_hot_stages(categorical, "raw", numeric)).fit(tr)
    tr, te = pm.transform(tr).select("raw", "origin"), pm.transform(te).select("raw", "origin")
    if not svd_k:
        return tuple(x.select(vector_to_array("raw").alias("x"), "origin") for x in (tr, te))
    first = tr.first()
    v = svd_components(tr, min(svd_k, len(first["raw"]) if first else svd_k))
    return _projected(tr, v), _projected(te, v)


def _gaussian_discriminant(tr: DataFrame, te: DataFrame, shared: bool) -> DataFrame:
    """LDA (shared covariance) / QDA (per class): moments from one blocked pass, the
    quadratic forms as matrix products of a batch."""
    k = len(tr.first()["x"])
    stats = class_moments(tr, "x", "origin", k)
    total = sum(n for n, _, _ in stats.values())
    pooled = sum(cov * (n - 1) for n, _, cov in stats.values()) / max(total - len(stats), 1)
    forms = []
    for c, (n, mean, cov) in stats.items():
        s = (pooled if shared else cov) + 1e-9 * np.eye(k)
        forms.append((c, mean, np.linalg.pinv(s), np.log(n / total) - (0.0 if shared else 0.5 * np.linalg.slogdet(s)[1])))

    def predict(batches):
        for b in batches:
            x = matrix(b)
            scores = [const - 0.5 * np.einsum("ij,jk,ik->i", x - mean, inverse, x - mean) for _, mean, inverse, const in forms]
            best = np.array([c for c, *_ in forms])[np.argmax(scores, axis=0)] if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column("origin"), pa.array(best.astype(np.int32))], ["origin", "pred"])

    return te.select("x", "origin").mapInArrow(predict, "origin double, pred int")


# training rows per cell of the neighbour index, cells that a row looks into, rows that a cell may have before it is
# cut, cuts in a row, cells that one is cut into
CELL_ROWS, PROBES, BLOCK_ROWS, CUTS, CHILDREN = 2000, 4, 4000, 8, 1024


def _least(d: np.ndarray, many: int) -> np.ndarray:
    """Places of the ``many`` least values of each row, in order, ties by place; ``d`` is used up."""
    out, rows = np.empty((len(d), min(many, d.shape[1])), np.int64), np.arange(len(d))
    for j in range(out.shape[1]):
        out[:, j] = d.argmin(1)
        d[rows, out[:, j]] = np.inf
    return out


class _Cells:
    """A tree of cells by nearest centre: the first centres' cells, and those of ``cuts``
    (cell -> centres) instead of a cell that is cut."""

    def __init__(self, centres: np.ndarray):
        self.centres, self.cuts = [centres], {}
        self.size = len(centres)
        self.close()

    def cut(self, cell: int, centres: np.ndarray) -> None:
        self.cuts[cell] = (self.size, len(self.centres))
        self.centres.append(centres)
        self.size += len(centres)

    def close(self) -> None:
        """After the cuts of a round: the centres as one matrix, and by cell whether it is cut, its
        first part, where that part's centre is, and how many parts there are."""
        self.every = np.concatenate(self.centres)
        self.norms = (self.every**2).sum(1)
        starts = np.cumsum([0, *map(len, self.centres)])
        self.is_cut = np.zeros(self.size, bool)
        self.first, self.start, self.parts = (np.zeros(self.size, np.int64) for _ in range(3))
        for cell, (first, at) in self.cuts.items():
            self.is_cut[cell], self.first[cell], self.start[cell], self.parts[cell] = True, first, starts[at], len(self.centres[at])

    def roots(self, x: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``many`` nearest first cells of each row, in order, and how far they are (less x squared)."""
        c = self.centres[0]
        near = np.empty((len(x), min(many, len(c))), np.int64)
        far = np.empty(near.shape)
        for at in range(0, len(x), 256):  # distances stay in a core's cache
            d = self.norms[None, :len(c)] - 2 * x[at:at + 256] @ c.T
            near[at:at + 256] = _least(d.copy(), many) if many > 1 else d.argmin(1)[:, None]
            far[at:at + 256] = np.take_along_axis(d, near[at:at + 256], 1)
        return near, far

    def _children(self, x: np.ndarray, cell: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``cell``, cell, how far) of the ``many`` nearest parts of each row's cell, which is
        cut: rows whose cells have a like number of parts are looked at together."""
        first, start, parts = self.first[cell], self.start[cell], self.parts[cell]
        sizes, out = np.ceil(np.log2(parts)).astype(int), []
        for size in np.unique(sizes):
            group, j = np.flatnonzero(sizes == size), np.arange(1 << size)
            step = max(1, (1 << 14) >> size)
            for mine in (group[i:i + step] for i in range(0, len(group), step)):
                at = start[mine][:, None] + np.minimum(j, parts[mine][:, None] - 1)
                d = self.norms[at] - 2 * np.einsum("ijk,ik->ij", self.every[at], x[mine])
                d[j >= parts[mine][:, None]] = np.inf
                near = _least(d.copy(), many)
                far = np.take_along_axis(d, near, 1)
                there = np.arange(near.shape[1]) < parts[mine][:, None]
                out.append((np.repeat(mine, there.sum(1)), (first[mine][:, None] + near)[there], far[there]))
        return tuple(map(np.concatenate, zip(*out)))

    def find(self, x: np.ndarray, many: int, root: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of the cells each row of ``x`` is in or near: of the ``many`` nearest first
        ones (``root`` if they are known), and of each that is cut its ``many`` nearest, the ``many`` nearest of all."""
        near, d = self.roots(x, many) if root is None else (root[:, None], np.zeros((len(x), 1)))
        row, cell, d = np.repeat(np.arange(len(x)), near.shape[1]), near.ravel(), d.ravel()
        while (open_ := self.is_cut[cell]).any():
            got, found, far = self._children(x[row[open_]], cell[open_], many)
            row, cell, d = (np.concatenate(v) for v in ((row[~open_], row[open_][got]), (cell[~open_], found), (d[~open_], far)))
        order = np.lexsort((cell, d, row))
        row, cell = row[order], cell[order]
        kept = np.arange(len(row)) - np.searchsorted(row, row) < many
        return row[kept], cell[kept]


def nearest_neighbours(tr: DataFrame, te: DataFrame, k: int = 3, cell_rows: int = CELL_ROWS, probes: int = PROBES,
                       block: int = BLOCK_ROWS) -> DataFrame:
    """(origin, pred) of ``te`` by the majority of the k nearest rows (Euclid) of ``tr``.

    Every training row is in the index: k-means cells of about ``cell_rows`` rows, at most
    ``CHILDREN``, whose centres are fitted on a bounded sample. A cell of more than ``block``
    rows is cut by the nearest of some of its rows, drawn by their hashes, again and again, so
    that cells do not grow with the table or where rows are dense; the centres, one for
    ``cell_rows`` rows, are all the driver holds. A row looks into the
    ``probes`` nearest cells (tests measure recall against brute force). A cell that is still
    too large after ``CUTS`` cuts is searched in blocks by a hash. Equal training rows count as
    often as they occur but are kept once. Ties in distance go to the smaller hash of the row.
    """
    points = (tr.groupBy("x").agg(F.sum(F.when(F.col("origin") == 1, 1).otherwise(0)).alias("ones"), F.count(F.lit(1)).alias("n"))
              .withColumn("key", F.xxhash64("x")))
    points = save_stage(points, "neighbour_points")
    total = points.count()
    asked = save_stage(te.groupBy("x", "origin").agg(F.count(F.lit(1)).alias("times")).withColumn("id", F.xxhash64("x", "origin")), "asked")
    if not total:
        return te.select("origin", F.lit(0).alias("pred"))
    cells = max(1, min(CHILDREN, math.ceil(total / cell_rows)))
    bound = 20 * cells
    share = min(1.0, bound / total)
    sample = points.where(F.pmod("key", F.lit(2**30)) < int(2**30 * share)).select(array_to_vector("x").alias("features"))
    centres = np.array(KMeans(k=cells, seed=1, maxIter=10).fit(sample).clusterCenters()) if cells > 1 and sample.limit(cells + 1).count() > cells \
        else np.array([points.orderBy("key").first()["x"]])
    tree = _Cells(centres)

    def batches_of(batches, rows: int = 2048):
        return (b.slice(at, rows) for b in batches for at in range(0, b.num_rows, rows))

    def rooted(batches):
        for b in batches_of(batches):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tree.roots(matrix(b), 1)[0][:, 0], pa.int32())], [*b.schema.names, "root"])

    def cells_of(b: pa.RecordBatch) -> np.ndarray:
        return tree.find(matrix(b), 1, b.column("root").to_numpy())[1]

    def placed_in(batches):
        for b in batches_of(batches):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells_of(b), pa.int32())], [*b.schema.names, "cell"])

    def counted(batches):
        cell, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches_of(batches):
            cell, at = np.unique(np.concatenate([cell, cells_of(b)]), return_inverse=True)
            n = np.bincount(at, np.r_[n, np.ones(b.num_rows, np.int64)], len(cell)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(n)], ["cell", "rows"])

    # every row's first cell is looked up once; what is cut below it is followed from there
    columns = "x array<double>, ones long, n long, key long, root int"
    roots = save_stage(points.mapInArrow(rooted, columns), "neighbour_roots")
    opened, parents = roots, {i: i for i in range(cells)}  # the rows of first cells that hold a large one; the first cell of each
    large: list[tuple[int, int]] = []
    for cut in range(CUTS + 1):
        large = [(r["cell"], r["rows"]) for r in opened.select("x", "root").mapInArrow(counted, "cell int, rows long").groupBy("cell")
                 .agg(F.sum("rows").alias("rows")).where(F.col("rows") > block).collect()]
        if not large or cut == CUTS:
            break
        opened = roots.where(F.col("root").isin(sorted({parents[c] for c, _ in large})))
        share = {c: min(math.ceil(n / cell_rows), CHILDREN) / n for c, n in large}
        # few rows are drawn, so that is seen to before their cells are
        draw = F.pmod(F.xxhash64("key", F.lit(cut)), F.lit(2**30))
        shares = tr.sparkSession.createDataFrame(list(share.items()), "cell int, share double")
        drawn = (opened.where(draw < max(share.values()) * 2**30).mapInArrow(placed_in, columns + ", cell int")
                 .join(F.broadcast(shares), "cell").where(draw < F.col("share") * 2**30))
        found: dict[int, list] = {}
        for r in drawn.orderBy("cell", "key").select("cell", "x").collect():
            found.setdefault(r["cell"], []).append(r["x"])
        if not found:
            break
        for cell, rows in found.items():
            if len(rows) > 1:
                parents |= dict.fromkeys(range(tree.size, tree.size + len(rows)), parents[cell])
                tree.cut(cell, np.array(rows))
        tree.close()

    held = save_stage(roots.mapInArrow(placed_in, columns + ", cell int").drop("root"), "neighbour_cells")
    # few cells are still too large; only those are broadcast
    blocks = tr.sparkSession.createDataFrame([(c, math.ceil(n / block)) for c, n in large], "cell int, blocks int")
    many = F.coalesce("blocks", F.lit(1))
    held = held.join(F.broadcast(blocks), "cell", "left").withColumn("block", F.pmod("key", many).cast("int"))

    def place(batches):
        for b in batches_of(batches):
            row, cell = tree.find(matrix(b), probes)
            ends = pa.array(np.searchsorted(row, np.arange(b.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(ends, pa.array(cell, pa.int32()))], [*b.schema.names, "cells"])

    look = (asked.mapInArrow(place, "x array<double>, origin double, times long, id long, cells array<int>")
            .select("x", "id", F.explode("cells").alias("cell")).join(F.broadcast(blocks), "cell", "left")
            .withColumn("block", F.explode(F.sequence(F.lit(0), many - 1))))

    def nearest(key, left: pa.Table, right: pa.Table) -> pa.Table:
        p, order = matrix(right.combine_chunks().to_batches()[0]) if right.num_rows else None, right.column("key").to_numpy()
        out = {"id": [], "d": [], "key": [], "ones": [], "n": []}
        if p is not None:
            rank = np.argsort(order, kind="stable")
            p, order = p[rank], order[rank]
            ones, n = right.column("ones").to_numpy()[rank], right.column("n").to_numpy()[rank]
            norms = (p**2).sum(1)[None, :]
            for b in left.combine_chunks().to_batches(max_chunksize=128):
                d = (norms - 2 * matrix(b) @ p.T) + (matrix(b)**2).sum(1)[:, None]
                best = _least(d.copy(), k)
                out["id"].append(np.repeat(b.column("id").to_numpy(zero_copy_only=False), best.shape[1]))
                out["d"].append(np.take_along_axis(d, best, 1).ravel())
                for name, values in (("key", order), ("ones", ones), ("n", n)):
                    out[name].append(values[best].ravel())
        return pa.table({c: np.concatenate(v) if v else np.zeros(0, np.float64 if c == "d" else np.int64) for c, v in out.items()})

    found = (look.groupBy("cell", "block").cogroup(held.select("cell", "block", "x", "key", "ones", "n").groupBy("cell", "block"))
             .applyInArrow(nearest, "id long, d double, key long, ones long, n long"))
    # the k nearest, a point as often as it occurs: at most k points of each block a row looked into
    best = found.groupBy("id").agg(F.array_sort(F.collect_list(F.struct(F.round("d", 9).alias("d"), "key", "ones", "n"))).alias("near"))
    used = F.aggregate("near", F.struct(F.lit(k).cast("long").alias("left"), F.lit(0.0).alias("votes")), lambda a, p: F.struct(
        (a["left"] - F.least(a["left"], p["n"])).alias("left"), (a["votes"] + F.least(a["left"], p["n"]) * p["ones"] / p["n"]).alias("votes")))
    pred = best.select("id", used.alias("u")).select("id", (F.col("u.votes") / (k - F.col("u.left")) > 0.5).cast("int").alias("pred"))
    # every copy of an asked row has its prediction
    return (asked.join(pred, "id", "left").select("origin", F.coalesce("pred", F.lit(0)).alias("pred"),
                                                  F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("_copy")).drop("_copy"))


def distribution_check(a: DataFrame, b: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                       method: str = "GaussianNB", seed: int = 144, svd_k: int | None = None) -> DataFrame:
    """Hard-label AUC of telling ``a`` from ``b`` (> 0.5: distributions might differ)."""
    tr, te = _prepare(a, b, numeric, categorical, seed, svd_k)
    if method != "KNeighborsClassifier":  # reads it once
        tr = tr.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if method == "GaussianNB":
            m = NaiveBayes(modelType="gaussian", featuresCol="features", labelCol="origin").fit(
                tr.select(array_to_vector("x").alias("features"), "origin"))
            out = m.transform(te.select(array_to_vector("x").alias("features"), "origin")).withColumn("pred", F.col("prediction").cast("int"))
        elif method == "LinearDiscriminantAnalysis":
            out = _gaussian_discriminant(tr, te, shared=True)
        elif method == "QuadraticDiscriminantAnalysis":
            out = _gaussian_discriminant(tr, te, shared=False)
        elif method == "KNeighborsClassifier":
            out = nearest_neighbours(tr, te)
        else:
            raise ValueError(f"unknown method {method}")
        cm = auc_hard(confusion_matrix(out, "origin", "pred")).collect()
    finally:
        tr.unpersist()
    return a.sparkSession.createDataFrame(
        [(method, r["tn"], r["fp"], r["fn"], r["tp"], float(r["auc"]), bool(r["auc"] > 0.5)) for r in cm],
        "method string, tn long, fp long, fn long, tp long, auc double, might_differ boolean")
