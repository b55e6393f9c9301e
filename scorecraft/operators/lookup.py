"""Replacing levels by values from a fitted table (J5), without moving rows by level.

A fitted table has one row per (feature, level). Its size is counted before it is
used:

* up to ``IN_PLAN`` rows, all columns are replaced in one projection by literal maps;
* up to ``BROADCAST`` rows, every column is a broadcast hash join, asked for by name,
  so that it does not hang on the session's threshold;
* beyond that, rows and table meet on (level, salt): the table is repeated for each
  of ``SALTS`` salts and a row takes one by its own content, so a level that a third of
  all rows has is dealt to that many tasks.

The result is the same on every path. Levels are compared as strings; a NULL level
is looked up as ``null_level`` where that is given; what the table lacks becomes
``default``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IN_PLAN = 400
BROADCAST = 1_000_000
SALTS = 32


def _key(col: str, null_level: str | None) -> Column:
    level = F.col(col).cast("string")
    return level if null_level is None else F.coalesce(level, F.lit(null_level))


def replace_levels(df: DataFrame, table: DataFrame, cols: Sequence[str], value: str, default, null_level: str | None = None,
                   in_plan: int = IN_PLAN, broadcast: int = BROADCAST) -> DataFrame:
    """``df`` with each of ``cols`` replaced by ``value`` of ``table`` (feature, level, ``value``)."""
    cols = list(cols)
    if not cols:
        return df
    kind = table.schema[value].dataType.simpleString()
    used = table.where(F.col("feature").isin(cols)).select("feature", F.col("level").cast("string").alias("level"), value)
    few = used.limit(in_plan + 1).collect()
    if len(few) <= in_plan:
        maps: dict[str, list] = {c: [] for c in cols}
        for r in few:
            if r["level"] is not None:
                maps[r["feature"]] += [F.lit(r["level"]), F.lit(r[value]).cast(kind)]
        return df.withColumns({c: F.coalesce(F.create_map(*maps[c])[_key(c, null_level)], F.lit(default).cast(kind))
                               if maps[c] else F.lit(default).cast(kind) for c in cols})
    small = used.count() <= broadcast
    out = df
    for i, c in enumerate(cols):
        own = used.where(F.col("feature") == c).select(F.col("level").alias(f"__l{i}"), F.col(value).alias(f"__v{i}"))
        on = _key(c, null_level) == F.col(f"__l{i}")
        if small:
            out = out.join(F.broadcast(own), on, "left")
        else:
            salted = own.withColumn(f"__s{i}", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            plain = [F.col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
            salt = F.pmod(F.xxhash64(*plain, F.spark_partition_id()), F.lit(SALTS))  # any salt finds its row
            out = (out.withColumn(f"__t{i}", salt.cast("int"))
                   .join(salted.hint("shuffle_hash"), on & (F.col(f"__t{i}") == F.col(f"__s{i}")), "left").drop(f"__t{i}", f"__s{i}"))
        out = out.withColumn(c, F.coalesce(F.col(f"__v{i}"), F.lit(default).cast(kind))).drop(f"__l{i}", f"__v{i}")
    return out
