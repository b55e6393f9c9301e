"""Quality classifier (operator 6): a linear-chain CRF over the lines of a text.

Every line is good or bad. A line's features are its own and its neighbours'
(lengths, character classes, repetition, case, closing punctuation). The chain
is trained on labelled documents, each line taking its document's label;
forward-backward gives each line's probability of being good, and the mean
weighted by line length is the document's quality.

The fit reads a bounded sample: about ``TRAIN_DOCS`` labelled documents of each
class, chosen by a hash of their id, whole documents in hash order up to
``TRAIN_LINES`` lines. Scoring reads every document,
whole, in one pass without a shuffle; only the fitted weights are sent out.

Defined cases: a null or empty text is one empty line and gets a score; a null
doc_id is scored and held out; a null label teaches nothing; repeated rows get
equal scores; with labels of one class alone, or none, the score is that
class's share (1 without labels); other columns, lang and source included, are
never read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecraft.llm import crf
from scorecraft.llm.common import arrow_rows, arrow_stream, bounded_batches, keyed, original_id

TRAIN_DOCS = 1500
TRAIN_LINES = 120_000

# character classes of UTF-8 bytes: 0 lower, 1 upper, 2 digit, 3 space, 4 sentence
# punctuation, 5 other ASCII, 6 beyond ASCII, 7 line end
_CLASS = np.full(256, 5, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 6
_CLASS[[9, 11, 12, 13, 32]] = 3
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = 4
_CLASS[10] = 7
N_OWN = 20


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of the texts (their neighbours' included), lines per
    text, and the length of each line in bytes."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    kind = _CLASS[data]
    end = np.flatnonzero(kind == 7)
    start = np.r_[0, end[:-1] + 1]
    n = end - start
    own = np.zeros((len(n), N_OWN))
    size = np.maximum(n, 1)
    for c in range(7):
        count = np.add.reduceat(kind == c, start) if len(start) else np.zeros(0)
        own[:, c] = count / size
    own[:, 7] = np.log1p(n)
    own[:, 8] = n == 0
    own[:, 9] = n < 30
    upper, lower = own[:, 1], own[:, 0]
    own[:, 10] = upper > lower
    own[:, 11] = own[:, 5] > 0.04
    own[:, 12] = own[:, 2] > 0.2
    lines = [line for t in texts for line in t.split(b"\n")]
    for i, line in enumerate(lines):
        words = line.split()
        if not words:
            continue
        k = len(words)
        distinct = len(set(words))
        own[i, 13] = distinct / k
        own[i, 14] = k > 4 and distinct < 0.4 * k
        own[i, 15] = sum(map(bytes.__eq__, words[1:], words)) / k
        own[i, 16] = min(n[i] / k, 40.0)
        own[i, 17] = line.rstrip()[-1:] in (b".", b"!", b"?", b":", b'"')
        own[i, 18] = line.count(b"|") / k
        own[i, 19] = np.log1p(k)
    per_text = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
    begin = np.zeros(len(n), bool)
    begin[np.cumsum(per_text) - per_text] = True
    before, after = np.roll(own, 1, 0), np.roll(own, -1, 0)
    before[begin] = 0
    after[np.r_[begin[1:], True]] = 0
    return np.hstack([own, before, after]), per_text, n


def text_scores(model: crf.Crf | float, texts: list[bytes]) -> np.ndarray:
    """Length-weighted share of good lines of each text, 0 to 1."""
    if isinstance(model, float):
        return np.full(len(texts), model)
    x, lines, n = line_features(texts)
    p = crf.marginals(model.scores(x), model.step, model.first, lines)[:, 1]
    at = np.cumsum(lines) - lines
    w = n + 1.0
    return np.clip(np.add.reduceat(p * w, at) / np.add.reduceat(w, at), 0, 1)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, train_lines: int = TRAIN_LINES) -> crf.Crf | float:
    """The chain fitted on labelled rows that are not held out."""
    known = (labels.where(~held_out()).where(F.col("quality").isin(0, 1))
             .groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("quality").alias("y")))
    shares = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(shares) < 2:
        return float(next(iter(shares), 1))
    place = F.pmod(F.xxhash64("_id"), F.lit(2**30))  # by hash, so that a class of any size is cut before it moves
    cut = F.lit(False)
    for y, n in shares.items():
        cut = cut | ((F.col("y") == y) & (place < int(2**30 * min(1.0, train_docs / n))))
    chosen = known.where(cut).withColumn("_r", place).limit(4 * train_docs)  # about 2 x train_docs
    rows = keyed(docs).join(F.broadcast(chosen), "_id").select("y", "_r", "_text")
    sample = rows.orderBy("_r", "y", F.xxhash64("_text")).limit(2 * train_docs).collect()
    texts, ys, total = [], [], 0
    for r in sample:
        text = bytes(r["_text"])
        total += text.count(b"\n") + 1
        if total > train_lines and len(set(ys)) == 2:
            break
        texts.append(text)
        ys.append(r["y"])
    if len(set(ys)) < 2:
        return float(ys[0]) if ys else 1.0
    x, lines, _ = line_features(texts)
    return crf.fit(x, np.repeat(np.array(ys), lines), lines)


def scored(docs: DataFrame, model: crf.Crf | float) -> DataFrame:
    """(_id, _th, _text, score) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred weights

    def score(batches):
        for b in bounded_batches(batches, "_text", 2 << 20):
            yield {"_id": b.column("_id"), "_th": b.column("_th"),
                   "score": text_scores(shared.value, b.column("_text").to_pylist())}

    return arrow_stream(keyed(docs), score, "_id long, _th long, score double")


def accepted(docs: DataFrame, model: crf.Crf | float, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(b):
        import pyarrow as pa

        texts = [(t or "").encode() for t in b.column("text").to_pylist()]
        return b.filter(pa.array(text_scores(shared.value, texts) >= least))

    return arrow_rows(docs, keep, docs.schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) per document."""
    out = scored(docs, fit(docs, labels)).select(original_id().alias("doc_id"), "score")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
