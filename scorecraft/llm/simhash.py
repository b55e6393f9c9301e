"""Document fingerprints (operator 3): SimHash and Hamming search.

Terms are runs of two words, weighted by how often they occur. Each term's
256-bit hash votes on the bits of the fingerprint with its sign and weight; a
bit is set where the votes are positive. Votes are counted through byte
histograms, so a text costs a few numpy calls whatever its length.

``within_radius`` finds all fingerprints within a Hamming radius of stated
query fingerprints by permuted block tables: the bits are cut into
radius + AGREE blocks; two fingerprints within the radius agree on at least
AGREE whole blocks, so some table, keyed by AGREE blocks, has both under one
key. Candidates are verified by counting differing bits.

``with_next`` pairs every document with the next by ascending id in one
shuffle: range bounds are ids of the table itself, so the first document of
each range is known and is also sent to the end of the range before it.

Defined cases: a null or empty text, or one of white space alone, has no terms
and the zero fingerprint; equal texts have equal fingerprints; rows that repeat
an id follow one another by text hash; a null id comes first; a single row is
its own next; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecraft.llm.common import arrow_map, arrow_stream, ddl, keyed, original_id, partitions
from scorecraft.llm.words import mix, shingles, word_hashes

BITS = 256
TERM_WORDS = 2
RADIUS, AGREE = 8, 2
_SIGNS = 2 * np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64) - 1


def fingerprint(text: bytes, bits: int = BITS, term_words: int = TERM_WORDS) -> bytes:
    terms = shingles(word_hashes(text), term_words)
    votes = np.zeros(bits, np.int64)
    for j in range(bits // 64 if len(terms) else 0):
        columns = mix(terms, j + 7).view(np.uint8).reshape(-1, 8)
        for c in range(8):
            at = (8 * j + c) * 8
            votes[at:at + 8] = np.bincount(columns[:, c], minlength=256) @ _SIGNS
    return np.packbits(votes > 0).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal bits."""
    return 1.0 - (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() / (8 * len(a))


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", bits: int = BITS) -> DataFrame:
    """(doc_id, fingerprint binary) of every document."""
    out = arrow_map(keyed(docs, text, doc_id), lambda b: {
        "_id": b.column("_id"), "fingerprint": [fingerprint(t, bits) for t in b.column("_text").to_pylist()]},
        "_id long, fingerprint binary")
    return out.select(original_id().alias("doc_id"), "fingerprint")


def _block_keys(column: str, bits: int, radius: int, agree: int):
    """An array of (table, key): the bits of each choice of ``agree`` blocks."""
    blocks = radius + agree
    text = F.lpad(F.conv(F.hex(column), 16, 2), bits, "0") if bits <= 64 else F.array_join(
        F.transform(F.sequence(F.lit(0), F.lit(bits // 4 - 1)), lambda i: F.lpad(
            F.conv(F.substring(F.hex(column), i + 1, F.lit(1)), 16, 2), 4, "0")), "")
    edges = [i * bits // blocks for i in range(blocks + 1)]
    part = [F.substring(text, a + 1, b - a) for a, b in zip(edges, edges[1:])]
    return F.array(*[F.struct(F.lit(i).alias("table"), F.concat(*[part[b] for b in pick]).alias("key"))
                     for i, pick in enumerate(combinations(range(blocks), agree))])


def within_radius(queries: DataFrame, all_rows: DataFrame, radius: int = RADIUS, agree: int = AGREE, bits: int = BITS) -> DataFrame:
    """(query_fingerprint, fingerprint, distance): every distinct fingerprint of
    ``all_rows`` within ``radius`` bits of each distinct fingerprint of ``queries``
    (both hold a binary ``fingerprint``). Join back for the documents."""
    keys = _block_keys("fingerprint", bits, radius, agree)
    q = queries.select("fingerprint").distinct().select(F.col("fingerprint").alias("query_fingerprint"), F.inline(keys))
    a = all_rows.select("fingerprint").distinct().select("fingerprint", F.inline(keys))
    pairs = q.join(a, ["table", "key"]).select("query_fingerprint", "fingerprint").distinct()

    def verify(batch: pa.RecordBatch) -> dict:
        d = [(int.from_bytes(x) ^ int.from_bytes(y)).bit_count() for x, y in zip(
            batch.column("query_fingerprint").to_pylist(), batch.column("fingerprint").to_pylist())]
        return {"query_fingerprint": batch.column("query_fingerprint"), "fingerprint": batch.column("fingerprint"), "distance": d}

    return arrow_map(pairs, verify, "query_fingerprint binary, fingerprint binary, distance long").where(F.col("distance") <= radius)


def with_next(rows: DataFrame, fn, columns: str) -> DataFrame:
    """``fn(row, next)`` -> dict for each row of ``keyed`` documents and the row
    after it by (id, text hash), the last row followed by the first."""
    spark = rows.sparkSession
    n = partitions(spark)
    shares = F.array(*[F.lit(i / n) for i in range(1, n)]) if n > 1 else F.array(F.lit(0.5))
    got = rows.agg(F.percentile_approx("_id", shares, F.lit(max(10_000, 20 * n))).alias("b"), F.min("_id").alias("low")).first()
    if got["low"] is None:
        return spark.createDataFrame([], ddl(columns))
    # each bound is an id of the table: it opens a range, so its rows also close the range before
    bounds = np.array(sorted({b for b in got["b"] if b > got["low"]}), np.int64)
    low, last = got["low"], len(bounds)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column("_id").to_numpy()
            own = np.searchsorted(bounds, ids, side="right").astype(np.int32)
            yield {"pid": own, "late": np.zeros(len(ids), bool), "_id": ids, "_th": b.column("_th"), "_text": b.column("_text")}
            opens = (own > 0) & (ids == bounds[own - 1]) if last else np.zeros(len(ids), bool)
            for where, to in ((opens, own - 1), (ids == low, np.full(len(ids), last, np.int32))):
                if where.any():
                    at = pa.array(np.flatnonzero(where))
                    yield {"pid": to[where], "late": np.ones(where.sum(), bool), "_id": ids[where],
                           "_th": b.column("_th").take(at), "_text": b.column("_text").take(at)}

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held, done = None, False
        for b in batches:
            out = []
            for late, i, th, text in zip(*(b.column(c).to_pylist() for c in ("late", "_id", "_th", "_text"))):
                if done:
                    break
                row = {"_id": i, "_th": th, "_text": text}
                if held is not None:
                    out.append(fn(held, row))
                held, done = row, late
            if out:
                yield {k: [x[k] for x in out] for k in out[0]}

    dealt = arrow_stream(rows, place, "pid int, late boolean, _id long, _th long, _text binary")
    dealt = dealt.repartitionById(last + 1, F.col("pid")).sortWithinPartitions("pid", "late", "_id", "_th")
    return arrow_stream(dealt, pair, columns)


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def edit_report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""

    def compare(row: dict, after: dict) -> dict:
        for r in (row, after):
            if "fp" not in r:
                r["fp"], r["str"] = fingerprint(r["_text"]), r["_text"].decode("utf-8", "replace")
        new = edited(row["str"], after["str"]).encode()
        fp = fingerprint(new)
        return {"_id": row["_id"], "n_chars": len(row["str"]), "edited_sha256": hashlib.sha256(new).hexdigest(),
                "fingerprint": row["fp"].hex(), "edited_fingerprint": fp.hex(),
                "near_edited": likeness(row["fp"], fp), "near_next": likeness(row["fp"], after["fp"])}

    out = with_next(keyed(docs, text, doc_id), compare, "_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                                        "edited_fingerprint string, near_edited double, near_next double")
    return out.withColumn("_id", original_id()).withColumnRenamed("_id", "doc_id")
