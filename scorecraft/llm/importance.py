"""Target-distribution importance resampling (operator 12).

Documents are drawn with a chance that grows with how likely their features
are in the target texts against all documents. Features are runs of 1 to
``max_run`` consecutive words, hashed to buckets by the crc32 of their bytes.

Words are found by an Aho-Corasick dictionary. A slice of texts is folded to
bytes in which every delimiter is a space; its distinct words, each bounded by
a space on both sides, enter an automaton with (crc32, length) as payload, and
one scan emits the payloads in text order. A run's crc32 is composed from its
neighbours' payloads (shift by the length, exclusive or) without its bytes. The
dictionary is that of the slice alone, so memory follows the slice and no
dictionary of the corpus is gathered or broadcast; a worker keeps the automaton
for the next slice while that one brings few new words.

Passes: texts -> bucket numbers, 2 bytes a feature, written once; counts per
bucket from the written table (at most ``BUCKETS`` rows reach the driver);
gains of all buckets, a bounded list, go to the tasks; weights from the
written table. Ranks of the drawn rows come from
``ordered.prefix_sums``: rows are range-partitioned by score and their numbers
carried on from partition to partition, so no task sorts all of them.

Defined cases: a null or empty text has no features, weight 0 and the score of
its noise; a null id is written as nothing in the noise (``2024:``) and comes
first in ties; rows equal in id and text share score and take as many ranks;
texts are cut between words into pieces of ``PIECE`` bytes, runs crossing a cut
included, so a long text needs no more memory than a slice (a single word may
be longer); empty documents give an empty result; an empty target counts no
features; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorecraft.llm.common import arrow_stream, bounded_batches, keyed, original_id, staged
from scorecraft.llm.sharding import one_row_each
from scorecraft.operators.ordered import prefix_sums

BUCKETS = 10_000
MAX_RUN = 1
SLICE = 4 << 20
PIECE = 1 << 20
# a dictionary this large is left to the memory and another begun
DICTIONARY = 400_000
# contract: drawn share in percent, least words of a document that may be drawn, seed of the noise
PERCENT, LEAST_WORDS, SEED = 10, 20, 2024

_POLYNOMIAL = 0xEDB88320  # crc32, reflected (fixed value)
_SPACE, _END = 0x20, 0x0A
#: A-Z to a-z, other ASCII but 0-9 and a-z to a space; bytes of other code points stay
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else _SPACE for b in range(256))


def _zero_byte(state: np.ndarray) -> np.ndarray:
    for _ in range(8):
        state = state >> np.uint32(1) ^ np.where(state & np.uint32(1), np.uint32(_POLYNOMIAL), np.uint32(0))
    return state


class Shift:
    """What a crc32 becomes after any number of zero bytes: four look-ups for each
    bit of that number. Tables are made by doubling."""

    def __init__(self):
        self.tables: list[np.ndarray] = []

    def table(self, bit: int) -> np.ndarray:
        while len(self.tables) <= bit:
            states = (np.arange(256, dtype=np.uint32)[None, :] << np.arange(0, 32, 8, dtype=np.uint32)[:, None])
            if not self.tables:
                self.tables.append(_zero_byte(states))
            else:
                half = len(self.tables) - 1
                self.tables.append(self.apply(half, self.apply(half, states)))
        return self.tables[bit]

    def apply(self, bit: int, crc: np.ndarray) -> np.ndarray:
        t = self.table(bit)
        return (t[0][crc & np.uint32(255)] ^ t[1][crc >> np.uint32(8) & np.uint32(255)]
                ^ t[2][crc >> np.uint32(16) & np.uint32(255)] ^ t[3][crc >> np.uint32(24)])

    def __call__(self, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
        out = crc.copy()
        for bit in range(int(length.max(initial=0)).bit_length()):
            on = (length >> bit & 1).astype(bool)
            out[on] = self.apply(bit, out[on])
        return out


def compose(shift: Shift, left: np.ndarray, right: np.ndarray, right_length: np.ndarray) -> np.ndarray:
    """crc32 of left + right from the crc32 of both."""
    return shift(left, right_length) ^ right


class Dictionary:
    """Delimiter-bounded words -> payload numbers; ``crc`` and ``length`` are the payloads."""

    def __init__(self):
        self.words: dict[bytes, int] = {}
        self.automaton, self.crc, self.length = None, None, None

    def hold(self, words: set[bytes]) -> None:
        new = words - self.words.keys()
        if not new and self.automaton is not None:
            return
        if len(self.words) + len(new) > DICTIONARY:
            self.words, new, self.automaton = {}, words, None
        if self.automaton is None:
            self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
            self.automaton.add_word(chr(_END), 0)
        for word in new:
            self.words[word] = number = len(self.words) + 1
            self.automaton.add_word(f" {word.decode('latin-1')} ", number)
        self.automaton.make_automaton()
        self.crc = np.fromiter(map(zlib.crc32, self.words), np.uint32, len(self.words))
        self.length = np.fromiter(map(len, self.words), np.int64, len(self.words))

    def scan(self, folded: bytes) -> np.ndarray:
        """Payload numbers in text order, 0 where a text ends."""
        return np.fromiter(map(itemgetter(1), self.automaton.iter(folded.decode("latin-1"))), np.int64)


def pieces(text: bytes, max_run: int = MAX_RUN, most: int = PIECE) -> Iterator[tuple[bytes, int]]:
    """(folded piece, number of carried words): whole words of at most ``most`` bytes
    unless one is longer, after the last ``max_run`` - 1 words of the piece before."""
    folded = text.translate(_FOLD)
    start, carried = 0, []
    while len(folded) - start > most:
        cut = folded.rfind(b" ", start + 1, start + most)
        cut = folded.find(b" ", start + most) if cut < 0 else cut
        if cut < 0:
            break
        piece = b" ".join([*carried, folded[start:cut]])
        yield piece, len(carried)
        if max_run > 1:
            carried = piece.split()[1 - max_run:]
        start = cut
    yield b" ".join([*carried, folded[start:]]), len(carried)


def run_crcs(shift: Shift, crc: np.ndarray, length: np.ndarray, owner: np.ndarray, max_run: int):
    """(crc32, last word) of all runs of 1 to ``max_run`` neighbours of one owner, by length."""
    space = np.uint32(zlib.crc32(b" "))
    run, last = crc, np.arange(len(crc))
    yield run, last
    for _ in range(1, max_run):
        more = last + 1 < len(crc)
        run, last = run[more], last[more]
        same = owner[last] == owner[last + 1]
        run, last = run[same], last[same] + 1
        spaced = compose(shift, run, np.full(len(run), space), np.ones(len(run), np.int64))
        run = compose(shift, spaced, crc[last], length[last])
        yield run, last


def text_buckets(texts: list[tuple[bytes, int]], dictionary: Dictionary, shift: Shift, max_run: int = MAX_RUN,
                 buckets: int = BUCKETS) -> list[tuple[int, np.ndarray]]:
    """(words, bucket of each feature) of every piece; runs that end in carried words are not its own."""
    split = [t.split() for t, _ in texts]
    dictionary.hold(set().union(*split))
    counts = np.array([len(w) for w in split], np.int64)
    del split
    # a space before and after every text bounds its first and last word
    found = dictionary.scan(b"".join(b" " + t + b" \n" for t, _ in texts))
    word = found[found > 0] - 1
    owner = np.repeat(np.arange(len(texts)), counts)
    starts = np.cumsum(counts) - counts
    carried = np.array([n for _, n in texts], np.int64)
    fresh = np.arange(len(word)) - starts[owner] >= carried[owner]
    crcs, owners = [], []
    for run, last in run_crcs(shift, dictionary.crc[word], dictionary.length[word], owner, max_run):
        own = fresh[last]
        crcs.append(run[own])
        owners.append(owner[last[own]])
    crcs, owners = np.concatenate(crcs), np.concatenate(owners)
    if max_run > 1:
        order = np.argsort(owners, kind="stable")
        crcs, owners = crcs[order], owners[order]
    numbers = crcs % np.uint32(buckets)
    ends = np.searchsorted(owners, np.arange(len(texts) + 1))
    return [(int(counts[i] - carried[i]), numbers[ends[i]:ends[i + 1]]) for i in range(len(texts))]


def features(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", max_run: int = MAX_RUN,
             buckets: int = BUCKETS) -> DataFrame:
    """(_id, _th, part, words, features, buckets): the buckets of every piece of every
    document, as little-endian unsigned numbers (16 bits up to 65,536 buckets)."""
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        dictionary, shift = Dictionary(), Shift()

        def emit(keys, texts):
            got = text_buckets(texts, dictionary, shift, max_run, buckets)
            ids, hashes, parts = zip(*keys)
            return {"_id": ids, "_th": hashes, "part": parts, "words": [n for n, _ in got],
                    "features": [len(b) for _, b in got], "buckets": [b.astype(kind).tobytes() for _, b in got]}

        for batch in bounded_batches(batches, "_text", SLICE):
            keys, texts, size = [], [], 0
            for i, row in enumerate(zip(batch.column("_id").to_pylist(), batch.column("_th").to_pylist())):
                for part, piece in enumerate(pieces(batch.column("_text")[i].as_py(), max_run)):
                    keys.append((*row, part))
                    texts.append(piece)
                    size += len(piece[0])
                    if size >= SLICE:
                        yield emit(keys, texts)
                        keys, texts, size = [], [], 0
            if keys:
                yield emit(keys, texts)

    return arrow_stream(keyed(docs, text, doc_id), run, "_id long, _th long, part int, words long, features long, buckets binary")


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def _joined(column: pa.Array, kind: str) -> np.ndarray:
    """The numbers of all rows of a binary column."""
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> dict[int, int]:
    """Features per bucket, zeros left out: at most ``buckets`` rows reach the driver."""
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total = np.zeros(buckets, np.int64)
        for batch in bounded_batches(batches, "buckets", SLICE):
            total += np.bincount(_joined(batch.column("buckets"), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield {"bucket": at, "n": total[at]}

    got = arrow_stream(found.select("buckets"), run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    return {r["bucket"]: r["n"] for r in got.collect()}


def bucket_gains(corpus: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """floor(1000 ln) of each bucket's share in the target over its share in the corpus, one added to every count."""
    s_all, t_all = sum(corpus.values()) + buckets, sum(target.values()) + buckets
    return [math.floor(1000 * math.log(((target.get(b, 0) + 1) * s_all) / ((corpus.get(b, 0) + 1) * t_all)))
            for b in range(buckets)]


def weights(found: DataFrame, gains: list[int]) -> DataFrame:
    """(_id, _th, copies, n_words, n_features, weight): one row for all copies of a document."""
    kind, gain = _kind(len(gains)), np.array(gains, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in bounded_batches(batches, "buckets", SLICE):
            n = np.array(batch.column("features").to_pylist(), np.int64)
            running = np.concatenate([[0], np.cumsum(gain[_joined(batch.column("buckets"), kind)])])
            ends = np.cumsum(n)
            yield {**{c: batch.column(c) for c in ("_id", "_th", "part", "words", "features")}, "gain": running[ends] - running[ends - n]}

    rows = arrow_stream(found, run, "_id long, _th long, part int, words long, features long, gain long")
    # copies of a document have equal sums, so their number divides the group's
    whole = rows.groupBy("_id", "_th").agg(F.count_if(F.col("part") == 0).alias("copies"), F.sum("words").alias("words"),
                                           F.sum("features").alias("features"), F.sum("gain").alias("gain"))
    return whole.select("_id", "_th", "copies", F.expr("words div copies").alias("n_words"),
                        F.expr("features div copies").alias("n_features"),
                        F.expr("CASE WHEN features = 0 THEN 0L ELSE (gain - pmod(gain, features)) div features END").alias("weight"))


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 x) of a Gumbel draw x that the id fixes."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", target_text: str = "text",
             max_run: int = MAX_RUN, buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; ``rank`` counts the
    drawn ones from 1, highest score first, then the smaller id, and is null for others."""
    found = staged(features(docs, text, doc_id, max_run, buckets), "features")
    wanted = features(target.select(F.col(target_text).alias("text"), F.lit(0).alias("doc_id")), "text", "doc_id", max_run, buckets)
    gains = bucket_gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets), buckets)
    scored = (weights(found, gains).withColumn("score", F.col("weight") + noise(original_id(), seed))
              .groupBy("_id", "n_words", "n_features", "weight", "score").agg(F.sum("copies").alias("copies")))
    scored = staged(scored, "scored")
    fit = F.col("n_words") >= least_words
    order = [F.col("score").desc(), *(F.col(c).asc() for c in ("_id", "n_features", "n_words"))]
    ranked = prefix_sums(scored.where(fit), [], order, ["copies"]).withColumn("_first", F.col("cum_copies") - F.col("copies") + 1)
    rest = scored.where(~fit).withColumns({c: F.lit(None).cast("long") for c in ("tot_copies", "_first")})
    rows = one_row_each(ranked.drop("cum_copies").unionByName(rest), "copies", "_first", "_rank")
    drawn = F.col("_rank") <= F.expr(f"tot_copies * {int(percent)} div 100")
    return rows.select(original_id().alias("doc_id"), "n_features", "weight", "score", F.when(drawn, F.col("_rank")).alias("rank"))
