"""Profiling and the contingency table.

Every profile is one global aggregate over all columns (a single scan with
map-side partial aggregation) followed by an unpivot of the one-row result:
the per-column Python loops of the reference become one job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import rnd
from .ordered import quantiles


def _one_row_to_long(row: DataFrame, cols: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """(c__s ...) one-row frame -> (feature, s...) rows."""
    structs = [F.struct(F.lit(c).alias("feature"), *[F.col(f"{c}__{s}").alias(s) for s in stats])
               for c in cols]
    return row.select(F.inline(F.array(*structs)))


def describe_numeric(df: DataFrame, cols: Sequence[str], dp: int = 2) -> DataFrame:
    """A1: count, min, max, mean, std (sample), 10%..90% per numeric column."""
    probs = [i / 10 for i in range(1, 10)]
    moments = df.agg(*[a for c in cols for a in (
        F.count(c).alias(f"{c}__count"), F.min(c).cast("double").alias(f"{c}__min"),
        F.max(c).cast("double").alias(f"{c}__max"), F.avg(c).alias(f"{c}__mean"),
        F.stddev_samp(c).alias(f"{c}__std"))])
    m = _one_row_to_long(moments, cols, ["count", "min", "max", "mean", "std"])
    q = quantiles(df, cols, probs)
    out = m.join(q, "feature", "left")
    pct = [rnd(F.col("values")[i], dp).alias(f"p{(i + 1) * 10}") for i in range(9)]
    return out.select("feature", F.col("count").cast("long").alias("count"),
                      *[rnd(c, dp).alias(c) for c in ("min", "max", "mean", "std")], *pct)


def missing_profile(df: DataFrame, cols: Sequence[str], dp: int = 3) -> DataFrame:
    """A2: missing count and share per column.

    ``missing_share`` divides by the row count; ``missing_share_max`` by the
    largest missing count of any column (the reference's denominator, T1;
    NULL when nothing is missing).
    """
    row = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.sum(F.col(c).isNull().cast("long")).alias(f"{c}__missing") for c in cols])
    long = _one_row_to_long(row.withColumns({f"{c}__rows": F.col("_rows") for c in cols}),
                            cols, ["missing", "rows"])
    mx = F.max("missing").over(Window.partitionBy())  # over #columns rows only
    return long.select(
        "feature", F.col("missing").cast("long").alias("missing"),
        rnd(F.when(F.col("rows") > 0, F.col("missing") / F.col("rows")), dp).alias("missing_share"),
        rnd(F.when(mx > 0, F.col("missing") / mx), dp).alias("missing_share_max"))


def distinct_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A3: distinct values excluding NULL (nunique) and including it (unique)."""
    row = df.agg(*[a for c in cols for a in (
        F.countDistinct(c).alias(f"{c}__nunique"),
        F.max(F.col(c).isNull().cast("int")).alias(f"{c}__hasnull"))])
    long = _one_row_to_long(row, cols, ["nunique", "hasnull"])
    return long.select("feature", F.col("nunique").cast("long").alias("nunique"),
                       (F.col("nunique") + F.coalesce("hasnull", F.lit(0))).cast("long").alias("n_unique_with_null"))


def approx_distinct_profile(df: DataFrame, cols: Sequence[str], rsd: float = 0.01) -> DataFrame:
    """A3 at scale: HyperLogLog++ counts (bounded memory, one pass)."""
    row = df.agg(*[F.approx_count_distinct(c, rsd).alias(f"{c}__nunique") for c in cols])
    return _one_row_to_long(row, cols, ["nunique"])


def value_counts(df: DataFrame, col: str, keys: Sequence[str] = ()) -> DataFrame:
    """A4: count per level (NULL level kept as its own row), largest first."""
    return df.groupBy(*keys, col).agg(F.count("*").alias("count")).orderBy(F.desc("count"), col)


def class_balance(df: DataFrame, target: str, keys: Sequence[str] = ()) -> DataFrame:
    """A5: count and share of each class."""
    vc = df.groupBy(*keys, target).agg(F.count("*").alias("count"))
    tot = F.sum("count").over(Window.partitionBy(*keys))  # over #classes rows
    return vc.select(*keys, target, "count", rnd(F.col("count") / tot, 6).alias("share"))


# ---------------------------------------------------------------------------
# G1: the contingency table.
# ---------------------------------------------------------------------------

def contingency(df: DataFrame, bins: Mapping[str, Column] | Sequence[str] = (),
                categorical: Sequence[str] = (), y: str = "y", keys: Sequence[str] = (),
                extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Cross-tab of every feature level / bin by a 0/1 target, for all features at once.

    ``bins``: feature -> bin-code column (or names of columns that already
    hold bin codes); ``categorical``: string columns used level by level.
    Result: (keys..., feature, bin int, level string, n, n1, n0, extra...)
    where n1 = sum(y). Rows whose feature value is NULL are dropped
    (crosstab ``dropna``). One scan, one shuffle of at most
    #keys x sum(#levels) rows per task.
    """
    if not isinstance(bins, Mapping):
        bins = {b: F.col(b) for b in bins}
    extra = dict(extra or {})
    structs = [F.struct(F.lit(f).alias("feature"), c.cast("int").alias("bin"),
                        F.lit(None).cast("string").alias("level")) for f, c in bins.items()]
    structs += [F.struct(F.lit(f).alias("feature"), F.lit(None).cast("int").alias("bin"),
                         F.col(f).cast("string").alias("level")) for f in categorical]
    extra_cols = [v.cast("double").alias(k) for k, v in extra.items()]
    if not structs:  # no feature at all: an empty table of the same columns
        structs = [F.struct(F.lit(None).cast("string").alias("feature"), F.lit(None).cast("int").alias("bin"),
                            F.lit(None).cast("string").alias("level"))]
    long = (df.select(*keys, F.col(y).cast("double").alias("_y"), *extra_cols,
                      F.inline(F.array(*structs)))
            .where(F.col("bin").isNotNull() | F.col("level").isNotNull()))
    agg = long.groupBy(*keys, "feature", "bin", "level").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_y").cast("long").alias("n1"),
        *[F.sum(k).alias(k) for k in extra])
    return agg.select(*keys, "feature", "bin", "level", "n", "n1",
                      (F.col("n") - F.col("n1")).alias("n0"), *extra.keys())
