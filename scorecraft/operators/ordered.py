"""Order statistics without a single-task sort.

Two building blocks used all over the library:

* :func:`prefix_sums` / :func:`running_totals` - cumulative sums along an order
  inside groups (KS curves, gain tables). A naive ``Window.orderBy(key)`` without
  ``partitionBy`` pulls every row into one task; here rows are range-partitioned
  by (group, order) once, written with the number of their partition, and the
  partitions' totals (#groups + #partitions rows) become offsets of a window
  inside each partition. The plan does not grow with the rows, and the source
  is read once. ``running_totals`` collapses equal keys first (map-side partial
  aggregation), so a key holding a third of all rows is one row.
* :func:`quantiles` - exact linear-interpolated quantiles (pandas, DuckDB
  ``quantile_cont`` and Spark ``percentile`` agree). One scan builds a mergeable
  KLL sketch of every column; its rank error gives a bracket of values around
  each wanted rank. The next scan counts what lies between the brackets and
  keeps values inside them only. While a bracket may hold more than ``most``
  values, a scan sketches its inside and narrows it, so what is shuffled at the
  end is bounded by parameters and not by the number of distinct values.
  Counts are exact, and a rank that fell outside its bracket is noticed and
  searched again with wider ones: the sketch decides the work, not the result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import save_stage

# items of a KLL sketch, and its rank error at 99 % confidence as a share of all rows
KLL_K, KLL_ERROR = 1024, 0.0035
# steps in which a bracket's inside is cut to narrow it
GRID = 128
# values that a bracket may hold when its values are counted one by one
MOST_INSIDE = 200_000


def unpivot_numeric(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (),
                    value: str = "x") -> DataFrame:
    """Long form (keep..., feature, x) of numeric columns, NULL values dropped."""
    return (df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot(list(keep), list(cols), "feature", value)
            .where(F.col(value).isNotNull() & ~F.isnan(F.col(value))))


def prefix_sums(df: DataFrame, keys: Sequence[str], order: Sequence[Column], sums: Sequence[str],
                parts: int | None = None) -> DataFrame:
    """``df`` with, for each s in ``sums``, ``cum_s`` (its sum over the rows of the same
    keys up to and with this one in ``order``) and ``tot_s`` (over all rows of the keys).

    ``order`` should tell the rows of a group apart; rows equal in it are
    summed in any order. ``parts`` range partitions (default: the session's
    shuffle partitions). A NULL key is a group of its own.
    """
    keys, by = list(keys), [*map(F.col, keys), *order]
    ranged = df.repartitionByRange(parts, *by) if parts else df.repartitionByRange(*by)
    ranged = save_stage(ranged.withColumn("_p", F.spark_partition_id()), "ranged")
    part = ranged.groupBy(*keys, "_p").agg(*[F.sum(s).alias(f"_part_{s}") for s in sums])
    before = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*keys)
    offsets = part.select(
        F.col("_p").alias("_op"), *[F.col(k).alias(f"_o_{k}") for k in keys],
        *[F.coalesce(F.sum(f"_part_{s}").over(before), F.lit(0)).alias(f"_off_{s}") for s in sums],
        *[F.sum(f"_part_{s}").over(group).alias(f"tot_{s}") for s in sums])
    inside = (Window.partitionBy(*keys, "_p").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    same = F.col("_p") == F.col("_op")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    return ranged.join(offsets, same).select(
        *df.columns, *[(F.sum(s).over(inside) + F.col(f"_off_{s}")).alias(f"cum_{s}") for s in sums],
        *[F.col(f"tot_{s}") for s in sums])


def running_totals(df: DataFrame, keys: Sequence[str], order: str, sums: Sequence[str],
                   parts: int | None = None, descending: bool = False) -> DataFrame:
    """Distinct (keys, order) rows with the group sums and cumulative sums.

    Output columns: keys..., order, for each s in ``sums``: s, cum_s, tot_s.
    ``cum_s`` includes the current key (ties collapse to one row, so the
    result does not depend on how equal keys are ordered).
    """
    dist = df.groupBy(*keys, order).agg(*[F.sum(s).alias(s) for s in sums])
    return prefix_sums(dist, keys, [F.col(order).desc() if descending else F.col(order).asc()], sums, parts)


def _number(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def _merged(brackets: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """Brackets in order, those that meet made one."""
    out: list[tuple[float, float]] = []
    for a, b in sorted(brackets):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _small(df: DataFrame, keys: Sequence[str], rows: list[tuple], columns: str) -> DataFrame:
    """A table of fitted numbers: the group's keys (as ``_k_...``) and ``columns``."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.sparkSession.createDataFrame(rows, ", ".join([*[f"_k_{k} {types[k]}" for k in keys], columns]))


def _same_group(keys: Sequence[str]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return same


def _sketched(df: DataFrame, cols: Sequence[str], keys: Sequence[str], probs: Sequence[float], error: float, k: int) -> dict:
    """First scan: {group: {column: (n, brackets of all probs)}}; a column without values is left out."""
    agg = df.groupBy(*keys).agg(*[e for i, c in enumerate(cols) for e in (
        F.count(_number(c)).alias(f"_n{i}"), F.min(_number(c)).alias(f"_lo{i}"), F.max(_number(c)).alias(f"_hi{i}"),
        F.kll_sketch_agg_double(_number(c), F.lit(k)).alias(f"_s{i}"))])
    # the ranks a sketch is asked for are constants: prob +- the error and what n, at least ``few``, rounds off
    few = math.ceil(4 / error)
    first, last = [max(p - error - 2 / few, 0.0) for p in probs], [min(p + error + 2 / few, 1.0) for p in probs]
    at = F.array(*map(F.lit, first + last))
    out: dict = {}
    for r in agg.select(*keys, *[x for i in range(len(cols)) for x in (
            f"_n{i}", f"_lo{i}", f"_hi{i}",
            F.when(F.col(f"_n{i}") >= few, F.kll_sketch_get_quantile_double(f"_s{i}", at)).alias(f"_at{i}"))]).collect():
        per = out.setdefault(tuple(r[x] for x in keys), {})
        for i, c in enumerate(cols):
            if n := r[f"_n{i}"]:
                lo, hi, got = r[f"_lo{i}"], r[f"_hi{i}"], r[f"_at{i}"]
                per[c] = (n, [(lo if got is None or a <= 0 else got[j], hi if got is None or b >= 1 else got[len(probs) + j])
                              for j, (a, b) in enumerate(zip(first, last))])
    return out


def _celled(df: DataFrame, cols: Sequence[str], keys: Sequence[str], brackets: dict) -> DataFrame:
    """Long form (keys..., f, cell, v): the column's number, 2i for a value below its
    group's bracket i and above the one before, 2i + 1 with the value itself inside it.

    Without keys the ends are literals; with keys they come from a table of one
    row a group, joined on the keys.
    """
    width = {c: max((len(v.get(c, [])) for v in brackets.values()), default=0) for c in cols}
    if keys:
        rows = [(*g, *[[x for ab in v.get(c, []) for x in ab] for c in cols]) for g, v in brackets.items()]
        df = df.join(_small(df, keys, rows, ", ".join(f"_ends{i} array<double>" for i in range(len(cols)))), _same_group(keys))
    long = []
    for i, c in enumerate(cols):
        if not width[c]:
            continue
        x, cell = F.col(f"_x{i}"), None
        for j in range(width[c]):
            a, b = ([F.get(F.col(f"_ends{i}"), F.lit(2 * j + e)) for e in (0, 1)] if keys
                    else map(F.lit, brackets[()][c][j]))
            cell = F.when(x < a, 2 * j) if cell is None else cell.when(x < a, 2 * j)
            cell = cell.when(x <= b, 2 * j + 1)
        # a group with fewer brackets has null ends, which no value is below
        cell = cell.otherwise(2 * width[c])
        long.append(F.struct(F.lit(i).alias("f"), F.when(x.isNotNull(), cell).alias("cell"), x.alias("v")))
    wide = df.select(*keys, *([f"_ends{i}" for i in range(len(cols))] if keys else []),
                     *[_number(c).alias(f"_x{i}") for i, c in enumerate(cols)])
    return (wide.select(*keys, F.inline(F.array(*long))).where(F.col("cell").isNotNull())
            .withColumn("v", F.when(F.col("cell") % 2 == 1, F.col("v"))))


def _narrowed(df: DataFrame, cols: Sequence[str], keys: Sequence[str], probs: Sequence[float], found: dict, error: float,
              k: int) -> dict:
    """``found`` with narrower brackets: the cells are counted, and the inside of each
    bracket is sketched for the ranks that lie in it."""
    long = _celled(df, cols, keys, {g: {c: _merged(b) for c, (_, b) in v.items()} for g, v in found.items()})
    cells: dict = {}
    for r in long.groupBy(*keys, "f", "cell").count().collect():
        cells.setdefault(tuple(r[x] for x in keys), {}).setdefault(cols[r["f"]], {})[r["cell"]] = r["count"]
    grid = [j / GRID for j in range(GRID + 1)]
    inside = long.where(F.col("cell") % 2 == 1).groupBy(*keys, "f", "cell").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.kll_sketch_agg_double("v", F.lit(k)).alias("s"))
    points = {(*[r[x] for x in keys], r["f"], r["cell"]): [r["lo"], *r["at"][1:-1], r["hi"]] for r in inside.select(
        *keys, "f", "cell", "lo", "hi", F.kll_sketch_get_quantile_double("s", F.array(*map(F.lit, grid))).alias("at")).collect()}
    new = {g: {c: (n, list(b)) for c, (n, b) in v.items()} for g, v in found.items()}
    for g, per in found.items():
        for i, c in enumerate(cols):
            n, before = per.get(c, (0, None))[0], 0
            for cell, held in sorted(cells.get(g, {}).get(c, {}).items()):
                for t, p in enumerate(probs):
                    low = math.floor(p * (n - 1))
                    if cell % 2 and before <= low and min(low + 1, n - 1) < before + held:
                        at = points[(*g, i, cell)]
                        a = math.floor(((low - before) / held - error) * GRID)
                        b = math.ceil(((low + 2 - before) / held + error) * GRID)
                        new[g][c][1][t] = (at[max(a, 0)], at[min(b, GRID)])
                before += held
    return new


def reads_files(df: DataFrame) -> bool:
    """Whether the rows come straight from files, so that reading them again costs less than holding them."""
    nodes, seen = [df._jdf.queryExecution().optimizedPlan()], set()
    while nodes:
        node = nodes.pop()
        seen.add(node.nodeName().split()[0])
        nodes += [node.children().apply(i) for i in range(node.children().length())]
    return seen <= {"Project", "Filter", "LogicalRelation", "Relation"}


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], keys: Sequence[str] = (), method: str = "exact",
              accuracy: int = 10000, most: int = MOST_INSIDE, k: int = KLL_K, error: float = KLL_ERROR) -> DataFrame:
    """Quantiles of numeric columns: (keys..., feature, values array<double>).

    ``values[i]`` is the linear-interpolated quantile at ``probs[i]`` over the
    non-NULL, non-NaN values; a column without any has no row.

    This is a fit step: it runs eagerly, scans ``df`` twice (two scans more each
    time brackets may hold over ``most`` values) and returns a small local
    DataFrame. At most 2 rows a prob, group and column reach the driver.
    """
    keys, cols, probs = list(keys), list(cols), [float(p) for p in probs]
    spark = df.sparkSession
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([*[f"{x} {types[x]}" for x in keys], "feature string, values array<double>"])
    if method == "approx":
        res = unpivot_numeric(df, cols, keys).groupBy(*keys, "feature").agg(
            F.percentile_approx("x", probs, accuracy).cast("array<double>").alias("values"))
        return spark.createDataFrame(res.collect(), schema)
    if not cols:
        return spark.createDataFrame([], schema)
    # only the columns asked for are held between the scans, so that joins above are not run again
    numbers = df.select(*keys, *[_number(c).alias(c) for c in cols])
    if not reads_files(numbers):
        numbers = numbers.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        hits = _rank_hits(numbers, cols, keys, probs, most, k, error)
    finally:
        numbers.unpersist()
    return spark.createDataFrame(_interpolated(hits, keys, cols, len(probs)), schema)


def _rank_hits(df: DataFrame, cols: Sequence[str], keys: Sequence[str], probs: Sequence[float], most: int, k: int, error: float):
    """The values that hold the wanted ranks: rows of keys, f, v, i (which prob) and frac."""
    found = _sketched(df, cols, keys, probs, error, k)
    largest = max((n for v in found.values() for n, _ in v.values()), default=0)
    if not largest:
        return []
    held = largest * min(4 * error, 1.0)
    while held > most and 2 * error + 2 / GRID < 0.5:
        found = _narrowed(df, cols, keys, probs, found, error, k)
        held *= 2 * error + 2 / GRID
    long = _celled(df, cols, keys, {g: {c: _merged(b) for c, (_, b) in v.items()} for g, v in found.items()})
    counts = long.groupBy(*keys, "f", "cell", "v").agg(F.count(F.lit(1)).alias("c"))
    # a group's window holds its brackets' values, about most x probs, and no others
    up_to = Window.partitionBy(*keys, "f").orderBy("cell", "v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = counts.select(*keys, "f", (F.sum("c").over(up_to) * 2).alias("pos"), F.struct("v").alias("w"), *[
        F.lit(None).cast(t).alias(c) for c, t in (("i", "int"), ("side", "int"), ("frac", "double"))])
    # the wanted ranks stand between the rows, each before the value that ends behind it, however many probs there are
    wanted = []
    for g, per in found.items():
        for c, (n, _) in per.items():
            for i, p in enumerate(probs):
                low = math.floor(p * (n - 1))
                wanted += [(*g, cols.index(c), 2 * r + 1, i, side, p * (n - 1) - low) for side, r in enumerate((low, min(low + 1, n - 1)))]
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    ranks = df.sparkSession.createDataFrame(wanted, ", ".join([*[f"{x} {types[x]}" for x in keys], "f int, pos long, i int, side int, frac double"]))
    rows = held.unionByName(ranks.withColumn("w", F.lit(None).cast("struct<v:double>")))
    behind = Window.partitionBy(*keys, "f").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hits = (rows.withColumn("w", F.last("w", ignorenulls=True).over(behind)).where(F.col("i").isNotNull())
            .select(*keys, "f", F.col("w.v").alias("v"), "i", "side", "frac").collect())
    if any(h["v"] is None for h in hits):  # a rank outside its bracket
        return _rank_hits(df, cols, keys, probs, most, k, min(4 * error, 1.0))
    return hits


def _interpolated(hits, keys: Sequence[str], cols: Sequence[str], probs: int) -> list[tuple]:
    """Two values per group, column and prob -> the value between them."""
    ends: dict = {}
    for h in hits:
        ends.setdefault((*[h[x] for x in keys], cols[h["f"]]), {}).setdefault(h["i"], {})[h["side"]] = (h["v"], h["frac"])
    return [(*g, [per[i][0][0] + (per[i][1][0] - per[i][0][0]) * per[i][0][1] for i in range(probs)]) for g, per in ends.items()]
