"""Binning.

Edges are fitted on training rows in one distributed pass
(:func:`scorecraft.operators.ordered.quantiles`) and returned as a small
table ``(feature, edges array<double>)``. Applying them is a generated CASE
expression (right-closed, like pandas ``cut``), so it stays in codegen. The
edges table has a handful of numbers per feature; it is the fitted model
and is the only thing brought to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import EDGE_DP, cut, hist, round_edges
from .gram import summed
from .ordered import quantiles


def _probs(k: int) -> list[float]:
    return [i / k for i in range(k + 1)]


def _round_arr(c) -> Column:
    return F.transform(c, lambda e: F.round(e, EDGE_DP))


def quantile_edges(df: DataFrame, cols: Sequence[str], k: int = 5, keys: Sequence[str] = (),
                   method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """B1: qcut edges - k equal-frequency bins, duplicate edges dropped.

    Returns (keys..., feature, quantiles, edges): ``quantiles`` keeps all k+1
    interpolated points, ``edges`` their sorted distinct values (9 dp).
    """
    q = quantiles(df, cols, _probs(k), keys, method=method, accuracy=accuracy)
    return q.select(*keys, "feature", _round_arr("values").alias("quantiles"),
                    F.array_sort(F.array_distinct(_round_arr("values"))).alias("edges"))


def forced_edges(df: DataFrame, cols: Sequence[str], k: int = 5, keys: Sequence[str] = (),
                 method: str = "exact") -> DataFrame:
    """B2: the binner's forced path (its effective behaviour).

    Quantiles at 0, 1/k, ..., 1; if only two distinct values a < b remain,
    1 is put in front and the first original point becomes a/2, then sorted
    distinct (so edges become {1, a/2, b} plus a when a repeats).
    """
    q = quantile_edges(df, cols, k, keys, method)
    qs = F.col("quantiles")
    two = F.array_union(F.array(F.lit(1.0), F.round(qs[0] / 2, EDGE_DP)), F.slice(qs, 2, k))
    return q.select(*keys, "feature", F.when(F.size("edges") == 2, F.array_sort(F.array_distinct(two)))
                    .otherwise(F.col("edges")).alias("edges"))


def low_cardinality_levels(df: DataFrame, cols: Sequence[str], cutoff: int = 5) -> DataFrame:
    """Columns with <= cutoff distinct values (NULL counts as one).

    Returns (feature, n_distinct, levels array<double>, low_cardinality). One
    sketch pass finds the columns of few values; only those have their
    (feature, value) pairs shuffled. ``n_distinct`` of the others is the sketch's.
    """
    rough = df.agg(*[(F.approx_count_distinct(F.col(c).cast("double"), 0.02)
                      + F.max(F.col(c).isNull().cast("int"))).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    many = [(c, rough[f"n{i}"]) for i, c in enumerate(cols) if (rough[f"n{i}"] or 0) > 2 * cutoff + 10]
    cols = [c for c in cols if c not in dict(many)]
    wide = df.sparkSession.createDataFrame([(c, n, None, False) for c, n in many], "feature string, n_distinct long, levels array<double>, low_cardinality boolean")
    if not cols:
        return wide
    values = (df.select(*[F.col(c).cast("double").alias(c) for c in cols])
              .unpivot([], list(cols), "feature", "x").distinct())
    counts = values.groupBy("feature").agg(F.count("*").alias("n_distinct"))  # one row a column
    low = F.broadcast(counts.where(F.col("n_distinct") <= cutoff).select("feature"))
    levels = (values.where(F.col("x").isNotNull()).join(low, "feature")  # <= cutoff rows a column
              .groupBy("feature").agg(F.array_sort(F.collect_list("x")).alias("levels")))
    return (counts.join(levels, "feature", "left")
            .select("feature", "n_distinct", "levels", (F.col("n_distinct") <= cutoff).alias("low_cardinality")).unionByName(wide))


def _bin_means(cells: list[tuple[int, int, float, float]], grid: list[float], edges: list[float]):
    """Mean x and y per bin of ``edges``, from the cells (index, n, sum x, sum y) of the
    finer ``grid``, whose points hold all of ``edges``."""
    at = np.array([c[0] for c in cells])
    upper = np.array([grid[min(i + 1, len(grid) - 1)] for i in at])
    code = np.clip(np.searchsorted(edges, upper, side="left") - 1, 0, len(edges) - 2)
    n, sx, sy = (np.bincount(code, [c[j] for c in cells], len(edges) - 1) for j in (1, 2, 3))
    full = n > 0
    return sx[full] / n[full], sy[full] / n[full]


def _average_ranks(x: np.ndarray) -> np.ndarray:
    """Ranks from 1, ties at their mean."""
    s = np.sort(x)
    return (np.searchsorted(s, x, "left") + np.searchsorted(s, x, "right") + 1) / 2


def spearman(x: np.ndarray, y: np.ndarray) -> float:
    """Rank correlation; 0 where it is undefined (fewer than two points, or all tied)."""
    a, b = _average_ranks(x), _average_ranks(y)
    if len(a) < 2 or a.std() == 0 or b.std() == 0:
        return 0.0
    return float(np.corrcoef(a, b)[0, 1])


def _rounded_near(x: np.ndarray, grid: np.ndarray) -> np.ndarray:
    """``x`` with the values next to a grid point at the precision of edges, rounded as
    Spark's ``round`` does; the others lie on the same side of all points either way."""
    at = np.searchsorted(grid, x)
    gap = np.minimum(np.abs(x - grid[np.maximum(at - 1, 0)]), np.abs(x - grid[np.minimum(at, len(grid) - 1)]))
    near = (gap > 0) & (gap < 10.0 ** (1 - EDGE_DP) + 1e-15 * np.abs(x))
    if near.any():
        values, back = np.unique(x[near], return_inverse=True)
        step = Decimal(1).scaleb(-EDGE_DP)
        x = x.copy()
        x[near] = np.array([float(Decimal(repr(float(v))).quantize(step, ROUND_HALF_UP)) for v in values])[back]
    return x


def grid_sums(df: DataFrame, grids: Mapping[str, Sequence[float]], y: str) -> dict[str, list[tuple[int, int, float, float]]]:
    """Per column the cells (index, n, sum x, sum y) of its grid that hold rows, from one pass:
    a value is in the cell of the last grid point below it (the first if there is none)."""
    cols = list(grids)
    if not cols:
        return {}
    points = [np.array(grids[c]) for c in cols]
    ends = np.cumsum([0, *map(len, points)])

    def sums(batch):
        flat = batch.column("x").flatten()
        x = flat.to_numpy(zero_copy_only=False).reshape(-1, len(cols))
        there = flat.is_valid().to_numpy(zero_copy_only=False).reshape(x.shape)
        t, known = batch.column("y").to_numpy(zero_copy_only=False), batch.column("y").is_valid().to_numpy(zero_copy_only=False)
        out = np.zeros((3, ends[-1]))
        for j, grid in enumerate(points):
            ok = there[:, j] & known
            v = _rounded_near(x[ok, j], grid)
            cell = np.maximum(np.searchsorted(grid, v) - 1, 0)
            for i, w in enumerate((None, v, t[ok])):
                out[i, ends[j]:ends[j + 1]] = np.bincount(cell, w, len(grid))
        return out.ravel()

    rows = df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("x"), F.col(y).cast("double").alias("y"))
    n, sx, sy = summed(rows, sums, 3 * int(ends[-1])).reshape(3, -1)
    return {c: [(i, int(n[at]), sx[at], sy[at]) for i, at in enumerate(range(ends[j], ends[j + 1])) if n[at]] for j, c in enumerate(cols)}


def monotonic_edges(df: DataFrame, cols: Sequence[str], y: str = "y", max_bins: int = 20, force_bins: int = 5,
                    cutoff: float = 0.001, method: str = "exact") -> DataFrame:
    """The most quantile bins, from ``max_bins`` down to 2, whose mean x and mean
    y have a rank correlation of at least 1 - cutoff in size; else the forced
    edges (B2). Returns (feature, edges, bins): ``bins`` is NULL for forced ones.

    Two passes for all columns and bin numbers: the quantile points of all bin
    numbers form one grid, rows are summed per grid cell (a few hundred rows a
    column), and every candidate's bins are unions of cells.
    """
    spark = df.sparkSession
    ks = range(max_bins, 1, -1)
    probs = sorted({i / k for k in ks for i in range(k + 1)})
    points = {r["feature"]: dict(zip(probs, round_edges(r["values"]))) for r in
              quantiles(df, cols, probs, method=method).collect() if r["values"]}
    grids = {c: sorted(set(p.values())) for c, p in points.items()}
    chosen = {}
    for c, found in grid_sums(df, grids, y).items():
        for k in ks:
            edges = sorted({points[c][i / k] for i in range(k + 1)})
            if len(edges) > 2 and abs(spearman(*_bin_means(found, grids[c], edges))) >= 1 - cutoff:
                chosen[c] = (edges, k)
                break
    rest = [c for c in cols if c not in chosen]
    forced = edges_dict(forced_edges(df, rest, force_bins, method=method)) if rest else {}
    rows = [(c, *chosen.get(c, (forced.get(c, []), None))) for c in cols]
    return spark.createDataFrame(rows, "feature string, edges array<double>, bins int")


def custom_edges(spark, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """User edges as an edges table."""
    rows = [(f, [float(e) for e in sorted(set(v))]) for f, v in edges.items()]
    return spark.createDataFrame(rows, "feature string, edges array<double>")


def edges_dict(edges_df: DataFrame) -> dict[str, list[float]]:
    """Bring a fitted edges table to the driver (a few numbers per feature)."""
    return {r["feature"]: round_edges(r["edges"] or []) for r in edges_df.collect()}


def apply_bins(df: DataFrame, edges: Mapping[str, Sequence[float]], include_lowest: bool = True,
               prefix: str | None = None, missing_bin: int | None = None) -> DataFrame:
    """Replace (or add, with ``prefix``) each column by its bin index.

    Right-closed (a, b]; outside the edges -> NULL, or ``missing_bin`` (P18).
    """
    out = {}
    for f, e in edges.items():
        b = cut(F.col(f), e, include_lowest)
        if missing_bin is not None:
            b = F.coalesce(b, F.lit(missing_bin))
        out[f"{prefix}_{f}" if prefix else f] = b
    return df.withColumns(out)


def bin_table(edges: Mapping[str, Sequence[float]], spark, include_lowest: bool = True) -> DataFrame:
    """(feature, bin, lo, hi, label) for every fitted interval."""
    rows = []
    for f, e in edges.items():
        for i in range(len(e) - 1):
            left = "[" if (include_lowest and i == 0) else "("
            rows.append((f, i, float(e[i]), float(e[i + 1]), f"{left}{e[i]}, {e[i + 1]}]"))
    return spark.createDataFrame(rows, "feature string, bin int, lo double, hi double, label string")


def equal_width_edges(base: DataFrame, cur: DataFrame, cols: Sequence[str], k: int = 10) -> DataFrame:
    """step = round((max-min)/k) over both sets, edges = range(min, max, step).

    min and max are rounded to integers first; the last edge excludes max.
    A zero step gives no edges (the reference raises).
    """
    both = base.select(*cols).unionByName(cur.select(*cols))
    stats = both.agg(*[F.min(c).alias(f"{c}__lo") for c in cols],
                     *[F.max(c).alias(f"{c}__hi") for c in cols])
    rows = []
    for c in cols:
        lo = F.bround(F.col(f"{c}__lo"), 0)  # Python round(): half-to-even
        hi = F.bround(F.col(f"{c}__hi"), 0)
        step = F.bround((hi - lo) / k, 0)
        rows.append(F.struct(F.lit(c).alias("feature"), F.when(step > 0, F.sequence(
            lo.cast("long"), (hi - 1).cast("long"), step.cast("long")).cast("array<double>"))
            .otherwise(F.array().cast("array<double>")).alias("edges")))
    return stats.select(F.inline(F.array(*rows)))


def decile_edges(base: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """B8 edges: quantiles 0.1 .. 1.0 of the baseline (10 edges -> 9 bins)."""
    q = quantiles(base, cols, [i / 10 for i in range(1, 11)], keys)
    return q.select(*keys, "feature", _round_arr("values").alias("edges"))


def apply_hist(df: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """B8 binning: numpy.histogram semantics (left-closed, last bin closed)."""
    return df.withColumns({f: hist(F.col(f), e) for f, e in edges.items()})


def score_decile_edges(df: DataFrame, score: str = "score", bins: int = 10) -> list[float]:
    """Quantiles at i/bins rounded to 1 dp; the min edge -> 0, the max -> 1."""
    probs = [round(i * 1.0 / bins, 1) for i in range(bins + 1)]
    q = quantiles(df.select(F.col(score).alias("s")), ["s"], probs).first()["values"]
    lo, hi = min(q), max(q)
    e = [0.0 if v == lo else 1.0 if v == hi else v for v in q]
    return sorted(set(round_edges(e)))


def risk_band_edges(df: DataFrame, score: str = "score", k: int = 5, keys: Sequence[str] = ()) -> DataFrame:
    """Quantiles of the predicted probability at linspace(0, 1, k+1)."""
    q = quantiles(df.select(*keys, F.col(score).alias("s")), ["s"], _probs(k), keys)
    return q.select(*keys, F.array_sort(F.array_distinct(_round_arr("values"))).alias("edges"))


def assign_risk_band(df: DataFrame, edges: Sequence[float], score: str = "score",
                     out: str = "risk_band") -> DataFrame:
    """Right-closed cut without include_lowest (the minimum gets no band)."""
    return df.withColumn(out, cut(F.col(score), list(edges), include_lowest=False))


def bin_info(ct: DataFrame, edges_df: DataFrame) -> DataFrame:
    """Per feature and bin, the row count and the bin's lower bound.

    ``ct`` is a contingency table (feature, bin, n, ...); ``edges_df`` the
    fitted edges table.
    """
    lo = edges_df.select("feature", F.posexplode("edges").alias("bin", "min"))
    return (ct.where(F.col("bin").isNotNull()).groupBy("feature", "bin").agg(F.sum("n").alias("count"))
            .join(lo, ["feature", "bin"], "left")
            .select("feature", F.col("bin").alias("index"), "count", "min"))


def number_bins(df: DataFrame, feature: str = "feature", bin: str = "bin") -> Column:
    """Row number of a bin inside its feature (1-based), ordered by bin."""
    return F.row_number().over(Window.partitionBy(feature).orderBy(bin))
