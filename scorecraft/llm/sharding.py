"""Sharding (operator 11): jump consistent hashing, no ring table.

A row's stable key seeds the 64-bit linear congruential generator of the
published algorithm; each draw names the next shard count at which the key
would move, and the last such count below the wanted one is its shard. So the
shard follows from the key and the shard count alone (law ``key``), and one
more shard takes about 1 / (n + 1) of the rows, all of them into itself. One
walk gives the shard for n and for n + 1 shards.

Everything is Spark expressions. The walk is an ``aggregate`` over a short
sequence (a key moves about ln(n) times); the few keys that are not there after
``STEPS`` draws walk on, at most once for each shard. The generator multiplies
modulo 2^64 in 16-bit limbs, so that no product passes 63 bits and ANSI mode
makes no difference.

``manifest`` numbers the rows of each shard without a sort of a whole shard:
rows are dealt to ``PARTS`` parts of each shard by key and text together, parts
are numbered by a window each, and the parts' totals (at most shards x PARTS
rows) become offsets. Equal rows are counted before they are shuffled and
written out again from their count, so neither a hot id, nor a hot text, nor
one row repeated gathers in a task. Only numbers are shuffled, no texts.

``text_shard`` is the shard that a row's group (rows of equal text) gets where
the text's crc32 is the stable key: equal texts share it whatever their ids.

Defined cases: a null text counts as empty (size 8, crc32 0); a null id is the
lowest long as a key and null in the result; rows that repeat an id share its
shard and have slots of their own; texts of any length are read as they are,
one value a row; an empty table gives an empty result; other columns, whatever
their names, are kept by ``sharded`` and ignored by ``manifest``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorecraft.llm.common import NULL_ID, original_id, staged

SHARDS = 24
# bytes that a row costs besides its text (fixed value of the contract)
ROW_BYTES = 8
STEPS = 8
PARTS = 1024
# copies of one row that a task writes out at once
COPIES = 1 << 16

# the multiplier of the published generator (fixed value)
MULTIPLIER = 2862933555777941757
_LOW, _WORD = 0xFFFF, 0xFFFFFFFF


def _times_small(x: Column, limb: int) -> Column:
    """Low 32 bits of x * limb, x of 32 bits and limb of 16."""
    return (x * F.lit(limb)).bitwiseAND(F.lit(_WORD))


def _next_state(high: Column, low: Column) -> tuple[Column, Column]:
    """state * MULTIPLIER + 1 modulo 2^64; the state is two unsigned 32-bit halves."""
    limbs = [(MULTIPLIER >> (16 * i)) & _LOW for i in range(4)]
    first = low * F.lit(limbs[0]) + F.lit(1)
    middle = F.shiftrightunsigned(first, 16) + low * F.lit(limbs[1])
    new_low = F.shiftleft(middle.bitwiseAND(F.lit(_LOW)), 16).bitwiseOR(first.bitwiseAND(F.lit(_LOW)))
    upper = [_times_small(low, limbs[2]), F.shiftleft(_times_small(low, limbs[3]).bitwiseAND(F.lit(_LOW)), 16),
             _times_small(high, limbs[0]), F.shiftleft(_times_small(high, limbs[1]).bitwiseAND(F.lit(_LOW)), 16)]
    new_high = F.shiftrightunsigned(middle, 16) + upper[0] + upper[1] + upper[2] + upper[3]
    return new_high.bitwiseAND(F.lit(_WORD)), new_low


def _step(state: Column, goal: int) -> Column:
    """One draw for a key that has not reached ``goal`` shards; others stay."""
    high, low = _next_state(state["high"], state["low"])
    jump = F.floor((state["next"] + F.lit(1)).cast("double")
                   * (F.lit(2147483648.0) / (F.shiftrightunsigned(high, 1) + F.lit(1)).cast("double")))
    moved = F.struct(high.alias("high"), low.alias("low"), state["at"].alias("before"), state["next"].alias("at"),
                     jump.cast("long").alias("next"))
    return F.when(state["next"] < F.lit(goal), moved).otherwise(state)


def _walk(state: Column, steps: int, goal: int) -> Column:
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), state, lambda s, _: _step(s, goal))


def jump_shards(key: Column, shards: int) -> Column:
    """struct(shard, grown_shard) of a long key: its shard of ``shards`` and of one more."""
    if not 1 <= shards < 2**31 - 1:
        raise ValueError("shards must be from 1 to 2^31 - 2")
    goal = shards + 1
    key = key.cast("long")
    start = F.struct(F.shiftrightunsigned(key, 32).alias("high"), key.bitwiseAND(F.lit(_WORD)).alias("low"),
                     F.lit(-1).cast("long").alias("before"), F.lit(-1).cast("long").alias("at"),
                     F.lit(0).cast("long").alias("next"))
    some = _walk(start, min(STEPS, goal), goal)
    # a draw moves a key at least one shard up, so ``goal`` draws end every walk
    done = F.transform(F.array(some), lambda s: F.when(s["next"] >= F.lit(goal), s).otherwise(_walk(s, goal, goal)))[0]
    return F.transform(F.array(done), lambda s: F.struct(
        F.when(s["at"] < F.lit(shards), s["at"]).otherwise(s["before"]).cast("int").alias("shard"),
        s["at"].cast("int").alias("grown_shard")))[0]


def stable_key(col: str | Column) -> Column:
    """A long to hash: an integer as it is (null: the lowest long), anything else by its text's hash."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("long"), F.lit(NULL_ID))


def sharded(df: DataFrame, shards: int = SHARDS, key: str | Column = "doc_id", into: str = "shard",
            grown: str | None = None) -> DataFrame:
    """``df`` with the column ``into`` (and ``grown``, for one more shard): no shuffle.

    ``key`` is an integer column; pass ``F.xxhash64(...)`` for keys of another type."""
    both = jump_shards(stable_key(key), shards)
    out = df.withColumn(into, both["shard"])
    return out if grown is None else out.withColumn(grown, both["grown_shard"])


def write_shards(df: DataFrame, path: str, shards: int = SHARDS, key: str | Column = "doc_id", into: str = "shard",
                 rows_per_file: int = 1_000_000) -> None:
    """One folder a shard below ``path``. Every task appends files to the shards its
    rows belong to, so no shard passes through one task."""
    (sharded(df, shards, key, into).write.option("maxRecordsPerFile", rows_per_file)
     .partitionBy(into).mode("error").parquet(path))


def manifest(docs: DataFrame, shards: int = SHARDS, text: str = "text", doc_id: str = "doc_id",
             parts: int = PARTS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, text_shard), one row a document.

    Slots follow (part, id, crc32, size) within a shard; rows equal in all of
    them are alike in every column."""
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(stable_key(doc_id).alias("_id"), (F.octet_length(body) + F.lit(ROW_BYTES)).cast("long").alias("size"),
                       F.crc32(body).alias("text_crc32"))
    equal = rows.groupBy("_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("_n"))
    key = F.col("_id")
    first_draw = F.shiftrightunsigned(_next_state(F.shiftrightunsigned(key, 32), key.bitwiseAND(F.lit(_WORD)))[0], 1)
    placed = (equal.withColumn("_at", jump_shards(key, shards))
              .select("_id", "size", "text_crc32", "_n", "_at.shard", "_at.grown_shard",
                      jump_shards(F.col("text_crc32"), shards)["shard"].alias("text_shard"),
                      F.pmod(first_draw + F.col("text_crc32"), F.lit(parts)).alias("_part")))
    placed = staged(placed, "placed")
    totals = placed.groupBy("shard", "_part").agg(F.sum("_n").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    inside = (Window.partitionBy("shard", "_part").orderBy("_id", "text_crc32", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    numbered = (placed.join(offsets, ["shard", "_part"])
                .withColumn("_first", F.col("_offset") + F.coalesce(F.sum("_n").over(inside), F.lit(0))))
    return one_row_each(numbered, "_n", "_first", "slot").select(
        original_id().alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard",
        "text_shard")


def one_row_each(df: DataFrame, count: str, first: str, into: str, copies: int = COPIES) -> DataFrame:
    """Every row ``count`` times, ``into`` running from ``first``. A row of very many
    copies is cut into blocks of ``copies``, which are dealt over all tasks first."""
    whole = df.where(F.col(count) <= copies).withColumn("_block", F.lit(0).cast("long"))
    blocks = (df.where(F.col(count) > copies)
              .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({count} - 1) div {copies}"))))
              .repartition(F.col(first), F.col("_block")))
    start = F.col("_block") * copies
    stop = F.least(start + copies, F.col(count)) - 1
    return (whole.unionByName(blocks).withColumn("_i", F.explode(F.sequence(start, stop)))
            .withColumn(into, F.col(first) + F.col("_i")).drop("_i", "_block"))
