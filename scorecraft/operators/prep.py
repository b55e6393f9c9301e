"""Row preparation: exclusions, de-duplication, target
derivation, imputation, category regrouping and numeric transforms.

All are narrow expressions or one global aggregate (statistics for
imputation), so they fuse into the scan's codegen stage. Statistics are
always fitted on training rows and replayed on other roles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import BAD_LABEL, GOOD_LABEL, MISSING_LEVEL
from ..functions.exprs import rnd
from .lookup import replace_levels
from .ordered import quantiles

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                 T.DecimalType)


def exclude_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop configured columns (missing names are ignored)."""
    return df.drop(*[c for c in cols if c in df.columns])


def all_null_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    """P2 fit: columns with no non-NULL value (one aggregate, one row back)."""
    cols = list(cols or df.columns)
    row = df.agg(*[F.count(c).alias(c) for c in cols]).first()
    return [c for c in cols if row[c] == 0]


def drop_all_null_columns(train: DataFrame, *others: DataFrame):
    """Drop columns entirely NULL in train, and the same list elsewhere."""
    dropped = all_null_columns(train)
    return (train.drop(*dropped), *[o.drop(*dropped) for o in others], dropped)


def drop_duplicate_rows(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Full-row de-duplication (per role when ``source`` is among the columns).

    NaN is folded into NULL first so that pandas' single missing value is
    matched (T21).
    """
    cleaned = df.select(*[
        F.when(~F.isnan(F.col(f.name)), F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else F.col(f.name)
        for f in df.schema.fields])
    return cleaned.dropDuplicates()


def check_same_columns(a: DataFrame, b: DataFrame, strict: bool = True) -> DataFrame:
    """Column-set difference rows (column, side); raises when ``strict``."""
    ca, cb = set(a.columns), set(b.columns)
    rows = [(c, "left_only") for c in sorted(ca - cb)] + [(c, "right_only") for c in sorted(cb - ca)]
    if rows and strict:
        raise ValueError(f"column sets differ: {rows}")
    return a.sparkSession.createDataFrame(rows, "column string, side string")


def derive_target(df: DataFrame, col: str, bad_values: Sequence[str] | None,
                  binomial: bool = True, out: str = "yTarget") -> DataFrame:
    """Listed values -> Level0; others (NULL included) -> level1.

    ``binomial=False`` keeps unlisted values as they are; no list copies
    the column.
    """
    c = F.col(col)
    if not bad_values:
        return df.withColumn(out, c.cast("string"))
    listed = c.isin(*bad_values)
    other = F.lit(BAD_LABEL) if binomial else c.cast("string")
    return df.withColumn(out, F.when(listed, F.lit(GOOD_LABEL)).otherwise(other))


def encode_target(df: DataFrame, col: str = "yTarget", out: str | None = None) -> DataFrame:
    """Level0 -> 0.0, level1 -> 1.0 (others NULL)."""
    c = F.col(col)
    return df.withColumn(out or col, F.when(c == GOOD_LABEL, 0.0).when(c == BAD_LABEL, 1.0))


def target_summary(df: DataFrame, target: str = "yTarget", raw: str | None = None,
                   bad_values: Sequence[str] = (), imbalance: float = 0.1,
                   small_rows: int = 5000, keys: Sequence[str] = ()) -> DataFrame:
    """Per class count and share, with the binomial / imbalance / size flags."""
    vc = df.groupBy(*keys, target).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(*keys)  # #classes rows per key
    out = vc.select(*keys, target, "count",
                    rnd(F.col("count") / F.sum("count").over(w), 6).alias("share"),
                    F.count(F.lit(1)).over(w).alias("n_classes"),
                    F.sum("count").over(w).alias("n_rows"))
    return out.select("*", (F.col("n_classes") == 2).alias("binomial"),
                      (F.min("share").over(w) < imbalance).alias("imbalanced"),
                      (F.col("n_classes") < 2).alias("too_few_classes"),
                      (F.col("n_rows") <= small_rows).alias("small_sample"))


# a prime modulus and a multiplier of full period for it (fixed values, published)
_PRIME, _STEP = 2147483647, 48271


def key_share(key: Column, seed: int) -> Column:
    """A number from 0 to 9,999 that an integer key and the seed fix, in any SQL engine:
    two steps of the multiplicative congruential generator."""
    first = F.pmod(F.pmod(key.cast("long"), F.lit(_PRIME)) * F.lit(_STEP) + F.lit(seed), F.lit(_PRIME))
    return F.pmod(F.pmod(first * F.lit(_STEP), F.lit(_PRIME)), F.lit(10_000))


def _share(df: DataFrame, key: str | None, seed: int) -> Column:
    if key and isinstance(df.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.coalesce(key_share(F.col(key), seed), F.lit(0))
    return F.pmod(F.xxhash64(*([key] if key else df.columns), F.lit(seed)), F.lit(10_000))


def split_by_key(df: DataFrame, key: str, test_fraction: float = 0.25, seed: int = 144,
                 out: str = "source") -> DataFrame:
    """Deterministic train/test split by a hash of a key (reproducible across runs, engines
    and partitionings, unlike ``randomSplit`` on recomputed input)."""
    return df.withColumn(out, F.when(_share(df, key, seed) < int(test_fraction * 10_000), "Test").otherwise("Train"))


def sample_rows(df: DataFrame, fraction: float = 0.1, seed: int = 144, key: str | None = None) -> DataFrame:
    """P10: about ``fraction`` of the rows (the reference samples 10 % of each role), chosen by a
    hash of ``key``, or of the whole row: the same rows whatever the partitioning."""
    return df.where(_share(df, key, seed) < int(fraction * 10_000))


def split_by_dtype(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric and categorical (string / boolean) feature lists."""
    num, cat = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, NUMERIC_TYPES):
            num.append(f.name)
        elif isinstance(f.dataType, (T.StringType, T.BooleanType)):
            cat.append(f.name)
    return num, cat


def select_features(df: DataFrame, feats: Sequence[str], target: str | None = None) -> DataFrame:
    """Column subset (projection pruning reaches the scan)."""
    return df.select(*feats, *([target] if target else []))


def high_missing(missing: DataFrame, threshold: float = 0.6, denominator: str = "rows") -> list[str]:
    """P13 fit: features whose missing share >= threshold (``missing_profile`` input)."""
    col = "missing_share" if denominator == "rows" else "missing_share_max"
    return [r["feature"] for r in missing.where(F.col(col) >= threshold).collect()]


def high_cardinality(df: DataFrame, cols: Sequence[str], max_levels: int = 15,
                     approx: bool = False) -> list[str]:
    """P14 fit: string features with more than ``max_levels`` distinct non-NULL values."""
    if not cols:
        return []
    row = df.agg(*[F.approx_count_distinct(c, 0.02).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    if approx:
        return [c for i, c in enumerate(cols) if row[f"n{i}"] > max_levels]
    # one sketch pass; only columns near the cut, which have few values, are counted exactly
    near = [c for i, c in enumerate(cols) if max_levels / 2 < row[f"n{i}"] <= 2 * max_levels + 10]
    over = {c for i, c in enumerate(cols) if row[f"n{i}"] > 2 * max_levels + 10}
    if near:
        exact = (df.select(*[F.col(c).cast("string").alias(c) for c in near]).unpivot([], near, "feature", "x")
                 .where(F.col("x").isNotNull()).distinct().groupBy("feature").count())
        over |= {r["feature"] for r in exact.where(F.col("count") > max_levels).collect()}
    return [c for c in cols if c in over]


def impute_values(df: DataFrame, cols: Sequence[str], how: str = "median",
                  const: float = -999.0) -> dict[str, float]:
    """P15 fit: fill value per numeric column from (training) data."""
    if how == "constant":
        return {c: float(const) for c in cols}
    if how == "mean":
        row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
        return {c: row[c] for c in cols if row[c] is not None}
    if how == "median":
        q = quantiles(df, cols, [0.5]).collect()
        return {r["feature"]: r["values"][0] for r in q}
    raise ValueError(how)


def impute_numeric(df: DataFrame, values: Mapping[str, float], how: str = "median") -> DataFrame:
    """P15 apply: ``fillna`` with fitted values; ``how='drop'`` drops rows with NULLs."""
    if how == "drop":
        return df.dropna(subset=list(values))
    return df.fillna({c: float(v) for c, v in values.items()})


def impute_log(df: DataFrame, values: Mapping[str, float], how: str) -> DataFrame:
    """P15 log table: (feature, missing count, how, value)."""
    cols = list(values)
    row = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols]).first()
    rows = [(c, int(row[c] or 0), how, float(values[c])) for c in cols]
    return df.sparkSession.createDataFrame(rows, "feature string, missing long, how string, value double")


def impute_categorical(df: DataFrame, cols: Sequence[str], value: str = MISSING_LEVEL) -> DataFrame:
    """Fill string NULLs."""
    return df.fillna(value, subset=list(cols))


def fill_unbinned_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Numeric NULL -> 0 when binning is off."""
    return df.fillna(0, subset=list(cols))


def missing_bin(df: DataFrame, bin_cols: Sequence[str] = (), cat_cols: Sequence[str] = (),
                bin_value: int = -1, level: str = MISSING_LEVEL) -> DataFrame:
    """NULL / out-of-range bin -> explicit missing bin; NULL level -> 'missing'."""
    return df.withColumns({**{c: F.coalesce(F.col(c), F.lit(bin_value)) for c in bin_cols},
                           **{c: F.coalesce(F.col(c), F.lit(level)) for c in cat_cols}})


def category_map(train: DataFrame, col: str, groups: Mapping[str, str]) -> DataFrame:
    """P19 fit: (level, grouped) for every level seen in train; unmapped levels map to themselves."""
    seen = train.select(F.col(col).cast("string").alias("level")).where(F.col("level").isNotNull()).distinct()
    m = F.create_map(*[x for k, v in groups.items() for x in (F.lit(k), F.lit(v))]) if groups else None
    grouped = F.coalesce(m[F.col("level")], F.col("level")) if m is not None else F.col("level")
    return seen.select("level", grouped.alias("grouped"))


def group_categories(df: DataFrame, col: str, mapping: DataFrame, level: str = MISSING_LEVEL) -> DataFrame:
    """P19 apply: replace levels by their group; levels unseen in train -> 'missing'.

    ``mapping`` has one row per training level; :func:`lookup.replace_levels` says how
    its size decides the plan.
    """
    table = mapping.select(F.lit(col).alias("feature"), "level", "grouped")
    return replace_levels(df, table, [col], "grouped", level)


def transform_numeric(df: DataFrame, how: Mapping[str, str]) -> DataFrame:
    """P20: 'log' (natural, NULL for x <= 0), 'sqrt' (NULL for x < 0), else reciprocal with 0 -> 0."""
    out = {}
    for c, h in how.items():
        x = F.col(c).cast("double")
        if h == "log":
            out[c] = F.when(x > 0, F.ln(x))
        elif h == "sqrt":
            out[c] = F.when(x >= 0, F.sqrt(x))
        else:
            out[c] = F.when(x != 0, F.lit(1.0) / x).otherwise(F.when(x.isNotNull(), F.lit(0.0)))
    return df.withColumns(out)


def role_filter(df: DataFrame, source: str | None = None, feature: str | None = None) -> DataFrame:
    """Predicate filter on a report table (pushed into its scan when read back)."""
    cond = F.lit(True)
    if source is not None:
        cond = cond & (F.col("source") == source)
    if feature is not None:
        cond = cond & (F.col("feature") == feature)
    return df.where(cond)
