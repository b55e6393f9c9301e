"""Line dedup (operator 1): range-partitioned line hashes with a secondary sort.

Every line long enough to count becomes a row (128-bit hash of its key,
document, position). The rows are range-partitioned and sorted by (hash,
document descending, position), so the occurrences of a key form one run and
its first row names the document that keeps it. A key that holds any share of
all rows simply covers several neighbouring partitions: the range key is
unique, so partitions stay even. One row per partition (its first and last
run) goes to the driver, which works out what each partition inherits from
its neighbours; then every partition streams its runs on its own. The result
is a compressed keep bitmap per document, never text.

Defined cases: a null or empty text is one empty line; a null doc_id counts as
one document below all others; rows that repeat a doc_id count as that one
document and each gets the decision for its own lines; equal rows get equal
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecraft.llm.common import (ASCII_SPACE, arrow_map, arrow_rows, arrow_stream, keyed, original_id, partitions,
                                    carried, set_column)

LINES = "h1 long, h2 long, nid long, _th long, pos int"
EDGES = "pid int, h1 long[], h2 long[], first_id long[], last_id long[], n_docs long[]"


def line_key(line: bytes) -> bytes:
    return line.strip(ASCII_SPACE).lower()  # bytes.lower() touches A-Z only


def code_points(key: bytes) -> int:
    return len(key) - int(np.count_nonzero((np.frombuffer(key, np.uint8) & 0xC0) == 0x80))


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least)


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line whose key has at least ``min_chars`` code points; ``nid``
    is the document id negated bitwise, so that ascending order is descending."""

    def lines(batch: pa.RecordBatch) -> dict:
        ids, ths = batch.column("_id").to_numpy(), batch.column("_th").to_numpy()
        row, pos, digests = [], [], []
        for i, text in enumerate(batch.column("_text").to_pylist()):
            for p, line in enumerate(text.split(b"\n")):
                if len(line) >= min_chars and _long_enough(key := line_key(line), min_chars):
                    row.append(i)
                    pos.append(p)
                    digests.append(xxhash.xxh3_128_digest(key))
        h = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
        row = np.array(row, np.int64)
        return {"h1": h[:, 0], "h2": h[:, 1], "nid": ~ids[row], "_th": ths[row], "pos": np.array(pos, np.int32)}

    return arrow_map(docs, lines, LINES)


def _runs(batches: Iterable[pa.RecordBatch]):
    """Arrays of a whole sorted partition and its runs: start of each run, number
    of documents in it."""
    t = pa.Table.from_batches(batches) if (batches := list(batches)) else None
    if t is None or not t.num_rows:
        return None
    col = {n: t.column(n).to_numpy() for n in ("h1", "h2", "nid", "_th", "pos")}
    new_key = np.r_[True, (col["h1"][1:] != col["h1"][:-1]) | (col["h2"][1:] != col["h2"][:-1])]
    new_doc = new_key | np.r_[True, col["nid"][1:] != col["nid"][:-1]]
    start = np.flatnonzero(new_key)
    return col, new_key, start, np.add.reduceat(new_doc.astype(np.int64), start)


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    got = _runs(batches)
    if got is None:
        return
    col, _, start, n_docs = got
    end = np.r_[start[1:], len(col["h1"])] - 1
    pick = [0] if len(start) == 1 else [0, -1]
    at = start[pick]
    yield {"pid": [TaskContext.get().partitionId()], "h1": [col["h1"][at]], "h2": [col["h2"][at]],
           "first_id": [col["nid"][at]], "last_id": [col["nid"][end[pick]]], "n_docs": [n_docs[pick]]}


def _inherited(edges: list) -> dict[int, list[tuple[int, int]]]:
    """For the first and last run of each partition: (first document of the whole
    run, documents in the whole run). ``edges`` has one row per partition."""
    runs: list[dict] = []
    for e in sorted(edges, key=lambda r: r["pid"]):
        for k in range(len(e["h1"])):
            key = (e["h1"][k], e["h2"][k])
            if k == 0 and runs and runs[-1]["key"] == key:
                run = runs[-1]
                run["n"] += e["n_docs"][k] - (run["last"] == e["first_id"][k])
                run["last"] = e["last_id"][k]
            else:
                run = {"key": key, "first": e["first_id"][k], "last": e["last_id"][k], "n": e["n_docs"][k], "in": []}
                runs.append(run)
            run["in"].append((e["pid"], k))
    out: dict[int, list] = {}
    for run in runs:
        for pid, k in run["in"]:
            out.setdefault(pid, [None, None])[k] = (run["first"], run["n"])
    return out


def dropped_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(_id, _th, pos) of every line to drop. ``docs`` as ``common.keyed`` gives it."""
    spark = docs.sparkSession
    lines = line_hashes(docs, min_chars)
    order = ["h1", "h2", "nid", "_th", "pos"]
    # Kept on executor disk: both passes must see one partitioning. A lost block is
    # rebuilt from the same shuffle, whose bounds are fixed, and a sort by all columns.
    placed = (lines.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
              .persist(StorageLevel.DISK_ONLY))
    known = _inherited(arrow_stream(placed, _edges, EDGES).collect())
    shared = spark.sparkContext.broadcast(known)  # two small tuples per partition

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        got = _runs(batches)
        if got is None:
            return
        col, new_key, start, n_docs = got
        first, n_docs = col["nid"][start].copy(), n_docs.copy()
        whole = shared.value[TaskContext.get().partitionId()]
        for at, k in ((0, 0), (-1, 1)):
            if whole[k] is not None:
                first[at], n_docs[at] = whole[k]
        run = np.cumsum(new_key) - 1
        drop = (n_docs[run] >= min_docs) & (col["nid"] != first[run])
        if drop.any():
            yield {"_id": ~col["nid"][drop], "_th": col["_th"][drop], "pos": col["pos"][drop]}

    return arrow_stream(placed, stream, "_id long, _th long, pos int")


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(_id, _th, bitmap): per document that loses lines the compressed bitmap of
    the lines to drop, bit i for line i (deflate over packed bits). A document
    without a row keeps all lines."""
    per_doc = dropped_lines(docs, min_chars, min_docs).groupBy("_id", "_th").agg(F.collect_set("pos").alias("pos"))

    def pack(batch: pa.RecordBatch) -> dict:
        maps = []
        for pos in batch.column("pos").to_pylist():
            bits = np.zeros(max(pos) + 1, np.uint8)
            bits[pos] = 1
            maps.append(zlib.compress(np.packbits(bits).tobytes()))
        return {"_id": batch.column("_id"), "_th": batch.column("_th"), "bitmap": maps}

    return arrow_map(per_doc, pack, "_id long, _th long, bitmap binary")


def apply_bitmap(text: bytes, bitmap: bytes | None) -> tuple[list[bytes], int]:
    """The kept lines of ``text`` and how many it had."""
    lines = text.split(b"\n")
    if bitmap is None:
        return lines, len(lines)
    drop = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))
    gone = set(np.flatnonzero(drop).tolist())
    return [x for i, x in enumerate(lines) if i not in gone], len(lines)


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, text: str = "text",
                doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, _th, text, n_lines, n_dropped): every document with its repeated
    lines removed. A key of at least ``min_chars`` code points found in at least
    ``min_docs`` documents stays in the largest doc_id alone."""
    rows = keyed(docs, text, doc_id)
    joined = rows.join(keep_bitmaps(rows, min_chars, min_docs), ["_id", "_th"], "left")

    def cut(batch: pa.RecordBatch) -> dict:
        kept, n, dropped = [], [], []
        for t, b in zip(batch.column("_text").to_pylist(), batch.column("bitmap").to_pylist()):
            lines, total = apply_bitmap(t, b)
            kept.append(t if b is None else b"\n".join(lines))
            n.append(total)
            dropped.append(total - len(lines))
        return {"_id": batch.column("_id"), "_th": batch.column("_th"), "_text": kept, "n_lines": n, "n_dropped": dropped}

    out = arrow_map(joined, cut, "_id long, _th long, _text binary, n_lines long, n_dropped long")
    return out.select(original_id().alias("doc_id"), "_th",
                      F.col("_text").cast("string").alias("text"), "n_lines", "n_dropped")


def cleaned(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with the repeated lines out of ``text`` (and ``n_chars``, where there is one, to
    match), all other columns, whatever their names, as they were."""
    rows = carried(docs)
    own = [c for c in rows.columns if c not in ("_id", "_th")]
    text = own[docs.columns.index("text")]
    chars = own[docs.columns.index("n_chars")] if "n_chars" in docs.columns else None
    joined = rows.join(keep_bitmaps(keyed(docs), min_chars, min_docs), ["_id", "_th"], "left").select(*own, "bitmap")

    def cut(b: pa.RecordBatch) -> pa.RecordBatch:
        bitmaps, texts = b.column("bitmap").to_pylist(), b.column(text).to_pylist()
        new = [t if bits is None else b"\n".join(apply_bitmap((t or "").encode(), bits)[0]).decode() for t, bits in zip(texts, bitmaps)]
        b = set_column(b, text, new)
        if chars:
            b = set_column(b, chars, [n if bits is None else len(t) for t, n, bits in zip(new, b.column(chars).to_pylist(), bitmaps)])
        return b.select(own)

    return arrow_rows(joined, cut, rows.select(*own).schema, text=text).toDF(*docs.columns)


def digest(deduped: DataFrame) -> DataFrame:
    return deduped.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))

