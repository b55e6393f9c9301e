"""Mixing sources to target weights (operator 2) by Sainte-Lague apportionment.

Every source gets a token target (weights, with a cap of so many passes over
the source; the excess is reshared by weight). Sources are dealt by a seeded
hash into shards of bounded size; each shard's documents, in seeded order, are
one run of words cut into blocks of equal length. Seats (blocks to take) go to
sources, then to groups of shards, then to shards, each time by the highest
quotients w, w/3, w/5, ... under the cap. Inside a shard the seats above whole
passes fall on a run of blocks that starts at a seeded place, so all but the
two documents at its ends are taken whole.

Only one row per source reaches the driver: the mix's own configuration, one
weight per source. A source of any size is many shards; no task sees more than
``SHARD_WORDS`` words' worth of (doc_id, size) rows or ``FANOUT`` shard totals.

Defined cases: a null or empty text has size 0 and is never taken; a null
source is a source, ordered last; a source of size 0 has target 0; a null
doc_id is the lowest id; rows that repeat a doc_id are separate documents;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecraft.llm.common import arrow_rows, original_id, staged, carried, one_of_equals, set_column

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
PASSES = 2
SHARD_WORDS = 1 << 17
SHARD_DOCS = 1 << 14
BLOCK_WORDS = 16
FANOUT = 4096
SEED = 20

# words are runs of anything but space and \x09-\x0D (fixed by the contract)
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: Sequence[float], weights: Sequence[float], total: float, passes: float) -> np.ndarray:
    """``total`` shared by weight, no target above ``passes`` times its size, the
    excess reshared among the rest by weight."""
    sizes, weights = np.asarray(sizes, float), np.asarray(weights, float)
    out, free, left = np.zeros(len(sizes)), np.ones(len(sizes), bool), float(total)
    while free.any():
        share = left * weights / weights[free].sum()
        over = free & (share > passes * sizes)
        if not over.any():
            out[free] = share[free]
            break
        out[over] = passes * sizes[over]
        left -= out[over].sum()
        free &= ~over
    return out


def sainte_lague(weights: np.ndarray, seats: int, caps: np.ndarray) -> np.ndarray:
    """Seats by the highest quotients w/(2k+1), at most ``caps`` each; ties go to
    the earlier place. Finds the quotient that fills the seats by bisection."""
    w, caps = np.asarray(weights, float), np.asarray(caps, np.int64)
    caps = np.where(w > 0, caps, 0)
    seats = int(min(seats, caps.sum()))
    if seats <= 0:
        return np.zeros(len(w), np.int64)

    def filled(q: float) -> np.ndarray:  # quotients of at least q
        return np.minimum(caps, np.floor((np.minimum(w / q, 2.0 * caps) + 1) / 2).astype(np.int64))

    low, high = w[w > 0].min() / (2.0 * caps.max() + 1), w.max() * 2
    for _ in range(200):
        mid = (low * high) ** 0.5
        if not low < mid < high:
            break
        low, high = (mid, high) if filled(mid).sum() >= seats else (low, mid)
    got = filled(high)
    while (short := seats - int(got.sum())) > 0:  # the last seats, tied or nearly so
        order = np.argsort(-np.where(got < caps, w / (2.0 * got + 1), -1.0), kind="stable")
        order = order[got[order] < caps[order]]
        got[order[:short]] += 1
    return got


def _seated(shards: DataFrame, parent: list[str], child: str, quota: str) -> DataFrame:
    """Splits each parent's ``quota`` among its children; at most FANOUT rows a group."""

    def share(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(child, ignore_index=True)
        return pdf.assign(quota=sainte_lague(pdf["words"].to_numpy(), int(pdf[quota].iloc[0]), pdf["cap"].to_numpy()))

    return shards.groupBy(*parent).applyInPandas(share, shards.schema)


def sized(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """(_id, _th, _source, size): words of every document."""
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("_id"),
                       F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_th"),
                       F.col(source).cast("string").alias("_source"),
                       F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def mix_plan(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, passes: int = PASSES,
             seed: int = SEED) -> DataFrame:
    """Per row of ``sizes`` (_id, _source, size, ...): source_size, target, taken,
    and what that is: the whole document ``times`` times, then its words
    [a1, b1) and [a2, b2) once more."""
    spark, sizes = sizes.sparkSession, staged(sizes, "sizes")
    per_source = sorted(sizes.groupBy("_source").agg(F.sum("size").alias("n"), F.count("*").alias("docs")).collect(),
                        key=lambda r: (r["_source"] is None, r["_source"] or ""))
    n = np.array([r["n"] for r in per_source], float)
    w = np.array([weights[i % len(weights)] for i in range(len(n))])
    target = targets(n, w, share * n.sum(), passes) if len(n) else n
    shards = np.array([max(1, -(-int(r["n"]) // SHARD_WORDS), -(-int(r["docs"]) // SHARD_DOCS)) for r in per_source])
    sources = spark.createDataFrame(
        [(r["_source"], int(r["n"]), float(t), int(k)) for r, t, k in zip(per_source, target, shards)],
        "_s string, source_size long, target double, shards long")
    rows = (sizes.join(sources, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
            .withColumn("_shard", F.pmod(F.xxhash64("_id", F.lit(seed)), "shards"))
            .withColumn("_group", F.floor(F.col("_shard") / FANOUT)))

    # one row per shard: its words and blocks; blocks of a shard are equal to within a word
    per_shard = staged(
        rows.groupBy("_source", "_group", "_shard").agg(F.sum("size").alias("words"))
        .withColumn("blocks", F.when(F.col("words") > 0, F.greatest(F.lit(1), F.round(F.col("words") / BLOCK_WORDS))).otherwise(0).cast("long"))
        .withColumn("cap", (passes * F.col("blocks")).cast("long")), "shards")
    blocks = {r["_source"]: r["b"] for r in per_shard.groupBy("_source").agg(F.sum("blocks").alias("b")).collect()}
    have = np.array([blocks.get(r["_source"], 0) for r in per_source], np.int64)
    ideal = np.divide(target * have, n, out=np.zeros(len(n)), where=n > 0)
    seats = sainte_lague(ideal, round(ideal.sum()), passes * have) if len(n) else have
    quotas = spark.createDataFrame([(r["_source"], int(q)) for r, q in zip(per_source, seats)], "_s string, quota long")

    groups = (per_shard.groupBy("_source", "_group").agg(F.sum("words").alias("words"), F.sum("cap").alias("cap"))
              .join(quotas, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s"))
    groups = _seated(groups, ["_source"], "_group", "quota")
    g = groups.select(F.col("_source").alias("_s"), F.col("_group").alias("_g"), "quota")
    seated = per_shard.join(g, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_group") == F.col("_g"))).drop("_s", "_g")
    seated = _seated(seated, ["_source", "_group"], "_shard", "quota")

    s = seated.select(F.col("_source").alias("_s"), F.col("_shard").alias("_k"), "blocks", "quota")
    rows = rows.join(s, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_shard") == F.col("_k"))).drop("_s", "_k")
    rows = rows.select("_source", "_shard", "_id", "size", "source_size", "target", "blocks", "quota",
                       *[c for c in sizes.columns if c not in ("_id", "_source", "size")])
    return rows.groupBy("_source", "_shard").applyInPandas(lambda pdf: _take(pdf, seed), ", ".join(
        [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name not in ("_shard", "blocks", "quota")]
        + ["taken long", "times long", "a1 long", "b1 long", "a2 long", "b2 long"]))


def _take(pdf: pd.DataFrame, seed: int) -> pd.DataFrame:
    """Block selection in one shard: whole passes, then a run of blocks from a
    seeded start, round the end if need be."""
    mixed = (pdf["_id"].to_numpy().astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    order = np.lexsort((pdf["size"].to_numpy(), pdf["_id"].to_numpy(), mixed * np.uint64(0xBF58476D1CE4E5B9)))
    pdf = pdf.iloc[order].reset_index(drop=True)
    size = pdf["size"].to_numpy(np.int64)
    end = np.cumsum(size)
    begin, words = end - size, int(end[-1])
    blocks, quota = int(pdf["blocks"].iloc[0]), int(pdf["quota"].iloc[0])
    times, more = divmod(quota, blocks) if blocks else (0, 0)
    first = int(np.random.default_rng([seed, int(pdf["_shard"].iloc[0]), blocks]).integers(0, blocks)) if blocks else 0
    edge = lambda k: k * words // max(blocks, 1)
    runs = [(edge(first), edge(min(first + more, blocks))), (0, edge(max(0, first + more - blocks)))]
    spans = []
    for lo, hi in runs:
        a = np.clip(lo - begin, 0, size)
        spans += [a, np.maximum(a, np.clip(hi - begin, 0, size))]
    taken = times * size + spans[1] - spans[0] + spans[3] - spans[2]
    out = pdf.drop(columns=["_shard", "blocks", "quota"])
    return out.assign(taken=taken, times=times, a1=spans[0], b1=spans[1], a2=spans[2], b2=spans[3])


def mix(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per document."""
    plan = mix_plan(sized(docs), **options)
    return plan.select(original_id().alias("doc_id"), "size", "source_size", "target", "taken")


_WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")


def words_between(text: str, a: int, b: int) -> str:
    """Words [a, b) of a text with the white space between them; the whole text if that is all of them."""
    data = text.encode()
    found = list(_WORD_BYTES.finditer(data))
    if a == 0 and b == len(found):
        return text
    return data[found[a].start():found[b - 1].end()].decode() if a < b else ""


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, all columns, whatever their names, as often as
    they are taken; a document at the end of a run of blocks is cut to the words taken
    (and its ``n_chars``, where there is one, to match). Rows that repeat both id and
    text count once; ``one_of_equals`` says which stays."""
    plan = mix_plan(sized(docs).dropDuplicates(["_id", "_th"]), **options).where("taken > 0")
    rows = carried(docs)
    own = [c for c in rows.columns if c not in ("_id", "_th")]
    text = own[docs.columns.index("text")]
    chars = own[docs.columns.index("n_chars")] if "n_chars" in docs.columns else None
    joined = one_of_equals(rows).join(plan.select("_id", "_th", "times", "a1", "b1", "a2", "b2"), ["_id", "_th"])

    def take(batch):
        import pyarrow as pa

        at, texts, whole = [], [], []
        cols = [batch.column(c).to_pylist() for c in (text, "times", "a1", "b1", "a2", "b2")]
        for i, (t, times, a1, b1, a2, b2) in enumerate(zip(*cols)):
            parts = [t] * times + [words_between(t, a, b) for a, b in ((a2, b2), (a1, b1)) if a < b]
            at += [i] * len(parts)
            texts += parts
            whole += [p is t for p in parts]
        out = set_column(batch.select(own).take(pa.array(at, pa.int64())), text, texts)
        if chars:
            out = set_column(out, chars, [n if same else len(t) for n, same, t in zip(out.column(chars).to_pylist(), whole, texts)])
        return out

    return arrow_rows(joined, take, rows.select(*own).schema, text=text).toDF(*docs.columns)
