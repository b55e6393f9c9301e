"""Best-fit packing (operator 4) with exact-complement hashing.

Documents become token ids plus an end id; longer ones are cut into pieces of
``capacity`` tokens. The plan is made on the histogram of piece lengths, which
has at most ``capacity`` rows however large the corpus: bins of one kind share
a class (gap left, how many such bins). For a class the lengths available are
hashed by single, pair and triple sums; a combination that fills the gap
exactly is consumed as often as its counts allow, and where none exists the
longest length that fits goes in (best fit) and the smaller gap is tried
again. Every step uses up a length or completes a class, so the steps, and
the runs handed to the tasks, are bounded by the number of lengths.

A run says: pieces of length L with ranks [first, first + n) lie in sequences
from ``seq`` on, ``each`` to a sequence, from ``offset`` on. Ranks within a
length come from salted counts (length, salt), so that a length held by any
share of all pieces is many groups.

Defined cases: a null or empty text is the end id alone; a null doc_id is the
lowest id; rows that repeat a doc_id are separate documents; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorecraft.llm.common import arrow_map, arrow_stream, bounded_batches, keyed, original_id, partitions, staged

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
SLICE_BYTES = 16 << 20  # of texts whose distinct words are held at once
RUN_BYTES = 1 << 20  # of texts that are cut into words, or whose ids are held, at once
JOINED = 256
_MARKS = ".,!?:;"
# letters below U+0250 are in normal form and, but for U+0130, have one letter as their lower case
_PLAIN = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]+[.,!?:;]?$"

_ENCODERS: dict[str, Encoder] = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _gathered(ids: np.ndarray, edge: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``at`` of those that ``edge`` cuts ``ids`` into, one after another, and their edges."""
    begin, n = edge[at], edge[at + 1] - edge[at]
    out = np.r_[0, np.cumsum(n)]
    place = np.repeat(begin - out[:-1], n)
    place += np.arange(len(place))
    return ids[place], out


class Encoder:
    """Token ids of whole texts.

    The tokenizer lower-cases, drops white space and never merges across it or
    between a letter and a mark. So a text's ids are those of its pieces between
    spaces and line ends; those of a piece of letters and one mark are its core's
    and the mark's; and plain words can be encoded many at a time, each ending at a
    token that ends a word. Each distinct piece of a call is encoded once, and the
    texts' ids are gathered from them; nothing is remembered between calls."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def _single(self, pieces: pa.Array) -> tuple[list[np.ndarray], list[int]]:
        out, sizes = [], []
        for at in range(0, len(pieces), 4096):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces[at:at + 4096].to_pylist(), add_special_tokens=False)]
            out.append(np.fromiter(chain.from_iterable(found), np.uint32))
            sizes += map(len, found)
        return out, sizes

    def _plain(self, words: pa.Array) -> tuple[list[np.ndarray], list[int]]:
        """Ids of words of plain lower-case letters, encoded many to a string."""
        out, sizes = [], []
        for at in range(0, len(words), JOINED):
            part = words[at:at + JOINED].to_pylist()
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) != len(part):
                raise ValueError("the tokenizer does not end each word with a token of its own")
            out.append(ids)
            sizes += np.diff(cut, prepend=0).tolist()
        return out, sizes

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words and their edges."""
        plain = pc.match_substring_regex(words, _PLAIN)
        of, other = words.filter(plain), words.filter(pc.invert(plain))
        cores = pc.utf8_lower(pc.utf8_rtrim(of, _MARKS)).dictionary_encode()
        units = [self._plain(cores.dictionary), self._single(pa.array(list(_MARKS))), self._single(other)]
        ids = np.concatenate([np.zeros(0, np.uint32), *chain.from_iterable(i for i, _ in units)])
        edge = np.cumsum([0, *chain.from_iterable(n for _, n in units)])
        # a word is its core's unit and that of its mark, any other word a unit of its own
        mark = pc.index_in(pc.utf8_slice_codeunits(of, -1), pa.array(list(_MARKS))).fill_null(-1).to_numpy(zero_copy_only=False)
        plain = plain.to_numpy(zero_copy_only=False)
        first, second = np.empty(len(words), np.int64), np.full(len(words), -1)
        first[plain] = cores.indices.to_numpy()
        first[~plain] = len(cores.dictionary) + len(_MARKS) + np.arange(len(other))
        second[plain] = np.where(mark >= 0, mark + len(cores.dictionary), -1)
        both = np.c_[first, second].ravel()
        ids, edge = _gathered(ids, edge, both[both >= 0])
        return ids, edge[np.r_[0, np.cumsum(1 + (second >= 0))]]

    def runs(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Run after run of the texts, about ``RUN_BYTES`` each: their ids, one after another,
        and their edges. Of all texts at once only the words' numbers are held."""
        size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        edges = np.r_[0, np.flatnonzero(np.diff(size // RUN_BYTES)) + 1, len(texts)].tolist()
        sizes, numbers = [], []
        for a, b in zip(edges, edges[1:]):
            parts = pc.split_pattern(pc.replace_substring(texts[a:b], "\n", " "), " ")
            sizes.append(pc.list_value_length(parts).to_numpy())
            numbers.append(parts.flatten().dictionary_encode())
        numbers = pa.chunked_array(numbers).unify_dictionaries()
        ids, edge = self._words(numbers.chunk(0).dictionary)
        for n, part in zip(sizes, numbers.chunks):
            found, at = _gathered(ids, edge, part.indices.to_numpy())
            yield found, at[np.r_[0, np.cumsum(n)]]

    def token_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and their edges."""
        runs = list(self.runs(texts))
        sizes = np.concatenate([[0], *(np.diff(edge) for _, edge in runs)])
        return np.concatenate([ids for ids, _ in runs]), np.cumsum(sizes)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Token ids of every text as little-endian unsigned 32-bit bytes."""
        ids, edge = self.token_ids(pa.array(texts, pa.string()))
        return [ids[a:b].astype("<u4").tobytes() for a, b in zip(edge, edge[1:])]


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _strings(texts: pa.Array) -> pa.Array:
    try:
        return texts.cast(pa.string())
    except pa.ArrowInvalid:  # bytes that are no UTF-8
        return pa.array([t.decode("utf-8", "replace") for t in texts.to_pylist()], pa.string())


def pieces(docs: DataFrame, capacity: int, end_id: int, path: str, with_ids: bool = False) -> DataFrame:
    """(_id, _th, piece, start, length, ids_crc32[, ids]) of every piece. ``docs`` as ``keyed``."""
    def cut(batches):
        enc = encoder(path)
        for b in bounded_batches(batches, "_text", SLICE_BYTES):
            for ids, edge in enc.runs(_strings(b.column("_text"))):
                yield cut_run(b[:len(edge) - 1], ids, edge)
                b = b[len(edge) - 1:]

    def cut_run(b: pa.RecordBatch, ids: np.ndarray, edge: np.ndarray) -> dict:
        ids = np.insert(ids, edge[1:], end_id).astype("<u4")
        edge = edge + np.arange(len(edge))
        many = -(-np.diff(edge) // capacity)
        row = np.repeat(np.arange(len(many)), many)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        begin = edge[row] + piece * capacity
        end = np.minimum(begin + capacity, edge[row + 1])
        blob = memoryview(ids).cast("B")
        parts = [blob[4 * x:4 * y] for x, y in zip(begin.tolist(), end.tolist())]
        cols = {"_id": b.column("_id").take(pa.array(row)), "_th": b.column("_th").take(pa.array(row)), "piece": piece,
                "start": piece * capacity, "length": end - begin, "ids_crc32": [zlib.crc32(p) for p in parts]}
        if with_ids:
            cols["ids"] = [p.tobytes() for p in parts]
        return cols

    return arrow_stream(docs, cut, "_id long, _th long, piece int, start long, length long, ids_crc32 long"
                        + ", ids binary" * with_ids)


def _filling(have: np.ndarray, gap: int, bins: int) -> list[int] | None:
    """One, two or three available lengths that sum to ``gap``; lengths needed twice
    must be there twice for at least one bin. Prefers few, then long, lengths."""
    if gap < len(have) and have[gap] > 0:
        return [gap]
    top = min(gap - 1, len(have) - 1)
    if top < 1:
        return None
    there = have[:top + 1] > 0

    def pair(total: int, most: int) -> list[int] | None:
        hi = min(total - 1, most, len(have) - 1)
        a = np.arange(hi, (total - 1) // 2, -1)
        if not len(a):
            return None
        ok = (have[a] > 0) & (have[total - a] > 0) & ((2 * a != total) | (have[a] > 1))
        at = int(ok.argmax())
        return [int(a[at]), total - int(a[at])] if ok[at] else None

    if two := pair(gap, top):
        return two
    for a in np.flatnonzero(there)[::-1].tolist():
        if 3 * a < gap:
            break
        if two := pair(gap - a, a):
            need = Counter([a, *two])
            if all(have[k] >= v for k, v in need.items()):
                return [a, *two]
    return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Runs (length, first, n, each, seq, offset) that place every piece counted."""
    have = np.zeros(capacity + 1, np.int64)
    for k, v in histogram.items():
        have[k] += v
    runs: list[tuple] = []
    used = np.zeros(capacity + 1, np.int64)
    seq = 0

    def put(length: int, each: int, bins: int, at_seq: int, offset: int) -> None:
        runs.append((length, int(used[length]), each * bins, each, at_seq, offset))
        used[length] += each * bins
        have[length] -= each * bins

    for length in range(capacity, 0, -1):
        if not have[length]:
            continue
        # the longest lengths open bins, as few as would hold them all; the rest of them may fill gaps
        while have[length]:
            bins = -(-int(have[length]) // (capacity // length))
            start = seq
            seq += bins
            put(length, 1, bins, start, 0)
            classes = [(start, bins, length)]
            while classes:
                s, m, filled = classes.pop()
                gap = capacity - filled
                if gap <= 0 or not have[1:gap + 1].any():
                    continue
                if combo := _filling(have, gap, m):
                    need = Counter(combo)
                    n = min(m, *(int(have[k]) // v for k, v in need.items()))
                    at = filled
                    for k, v in need.items():
                        put(k, v, n, s, at)
                        at += k * v
                else:
                    k = int(np.flatnonzero(have[:gap + 1])[-1])  # best fit
                    v = max(1, min(gap // k, int(have[k]) // m))
                    n = min(m, int(have[k]) // v)
                    put(k, v, n, s, filled)
                    classes.append((s, n, filled + k * v))
                if n < m:
                    classes.append((s + n, m - n, filled))
    return np.array(runs, np.int64).reshape(-1, 6)


def packed(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None,
           text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, _th, piece, start, length, ids_crc32, sequence_id, offset) per piece."""
    spark = docs.sparkSession
    cut = staged(pieces(keyed(docs, text, doc_id), capacity, end_id, path or tokenizer_path()), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    runs = plan(counts, capacity)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    shared = spark.sparkContext.broadcast(runs)

    salts = max(partitions(spark), sum(counts.values()) // 50_000 + 1)
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64("_id", "piece", "_th"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)  # one row a salt
    base = (salted.groupBy("length", "_salt").agg(F.count("*").alias("n"))
            .select("length", "_salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base")))
    inside = Window.partitionBy("length", "_salt").orderBy("_id", "_th", "piece")
    ranked = (salted.withColumn("_rank", F.row_number().over(inside) - 1).join(base, ["length", "_salt"])
              .withColumn("_rank", F.col("_rank") + F.col("_base")))

    def place(b: pa.RecordBatch) -> dict:
        r = shared.value
        length, rank = b.column("length").to_numpy(), b.column("_rank").to_numpy().astype(np.int64)
        stride = int(r[:, 2].max()) + int(r[:, 1].max()) + 1
        at = np.searchsorted(r[:, 0] * stride + r[:, 1], length * stride + rank, side="right") - 1
        nth = rank - r[at, 1]
        out = {c: b.column(c) for c in ("_id", "_th", "piece", "start", "length", "ids_crc32")}
        return out | {"sequence_id": r[at, 4] + nth // r[at, 3], "offset": r[at, 5] + (nth % r[at, 3]) * length}

    columns = "_id long, _th long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    out = arrow_map(ranked.select(*[c.split()[0] for c in columns.split(", ")[:6]], F.col("_rank").cast("long").alias("_rank")),
                    place, columns)
    return out.withColumn("_id", original_id()).withColumnRenamed("_id", "doc_id")


def sequences(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """(sequence_id, ids array<long>, doc_ids): the packed sequences themselves; a
    sequence holds at most ``capacity`` ids."""
    path = path or tokenizer_path()
    placed = packed(docs, capacity, end_id, path)
    key = ["_id", "_th", "piece"]
    ids = pieces(keyed(docs), capacity, end_id, path, with_ids=True).dropDuplicates(key).select(*key, "ids")
    rows = placed.withColumn("_id", F.coalesce("doc_id", F.lit(-(2**63)))).join(ids, key)
    whole = rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))

    def join(b: pa.RecordBatch) -> dict:
        ps = b.column("p").to_pylist()
        return {"sequence_id": b.column("sequence_id"), "doc_ids": [[x["doc_id"] for x in p] for p in ps],
                "ids": [np.frombuffer(b"".join(x["ids"] for x in p), "<u4").astype(np.int64) for p in ps]}

    return arrow_map(whole, join, "sequence_id long, ids long[], doc_ids long[]")
