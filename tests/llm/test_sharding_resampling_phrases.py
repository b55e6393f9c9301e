"""Operators 11 to 13 against brute force, and on odd inputs."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorecraft.llm import importance, phrases, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RNG = random.Random(11)
WORDS = ["".join(RNG.choice("abcdeXé9") for _ in range(RNG.randint(1, 5))) for _ in range(40)]


def sentence(n):
    return "".join(RNG.choice(WORDS) + RNG.choice([" ", " ", " ", "  ", "\t", ", ", "\n", ". ", "-", "  "]) for _ in range(n))


TEXTS = [sentence(RNG.randint(1, 60)) for _ in range(60)] + [
    None, "", " \n\t", "x", "one two three", "İstanbul ẞ K", "a\x00b\x7fc \x0bd", "new york city " * 30, "=" * 900,
    " ".join(sentence(50) for _ in range(30)), "w" * 5000 + " tail of a long word"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", None, "de", "und"][i % 4], "s", 1) for i, t in enumerate(TEXTS)]
    rows += [rows[3]] * 7 + [(None, "no id at all, but more than twenty words " * 3, "en", "s", 1)] * 2
    rows += [(None, "another", None, None, None), (4, "other text, same id", "en", "s", 1)]
    return spark.createDataFrame([(*r, "e", 1, 2) for r in rows], DOCS + ", shard string, slot int, _id int")  # clashing names


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def listed(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))


def published_jump(key, shards):
    key, b, j = key & (2**64 - 1), -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int(float(b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 24, 700])
def test_jump_is_the_published_function(spark, shards):
    keys = [RNG.randint(-2**63, 2**63 - 1) for _ in range(300)] + list(range(300)) + [-2**63, 2**63 - 1, -1]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for k, (a, b) in listed(df, "k", sharding.jump_shards(F.col("k"), shards)):
        assert (a, b) == (published_jump(k, shards), published_jump(k, shards + 1))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_manifest(spark, docs, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        got = sharding.manifest(docs, 5, parts=3).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    want = []
    for i, t in listed(docs, "doc_id", "text"):
        key, b = -2**63 if i is None else i, (t or "").encode()
        want.append((i, len(b) + 8, zlib.crc32(b), "key", published_jump(key, 5), published_jump(key, 6), published_jump(zlib.crc32(b), 5)))
    assert order([(r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard, r.text_shard) for r in got]) == order(want)
    for s in range(5):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))


def test_shards_are_even_and_grow_into_the_new_one(spark):
    df = sharding.sharded(spark.range(24_000).withColumnRenamed("id", "doc_id"), 24, into="s", grown="g").collect()
    sizes = Counter(r.s for r in df)
    assert min(sizes.values()) > 850 and max(sizes.values()) < 1150
    moved = [r for r in df if r.s != r.g]
    assert {r.g for r in moved} == {24} and 800 < len(moved) < 1120


def test_a_row_repeated_very_often(spark, monkeypatch):
    monkeypatch.setattr(sharding.one_row_each, "__defaults__", (100,))
    same = spark.range(5000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    got = sharding.manifest(same.unionByName(spark.createDataFrame([(1, "x")], "doc_id long, text string")))
    slots = sorted(r.slot for r in got.where("doc_id IS NULL").collect())
    assert len(slots) == 5000 and slots[-1] - slots[0] in (4999, 5000) and len(set(slots)) == 5000


def test_written_shards_hold_every_row(spark, docs, empty, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "out"), 4, into="part_of")
    back = spark.read.parquet(str(tmp_path / "out"))
    assert order(listed(back, "doc_id", "text", "shard", "part_of")) == order(
        [(*r, published_jump(-2**63 if r[0] is None else r[0], 4)) for r in listed(docs, "doc_id", "text", "shard")])
    assert sharding.manifest(empty).count() == 0


RUN_WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def resampled(rows, target, max_run, buckets, percent, least):
    def runs(t):
        w = RUN_WORDS.findall((t or "").translate(FOLD))
        return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, max_run + 1) for i in range(len(w) - k + 1)]
    found = [(i, *runs(t)) for i, t in rows]
    s, t = Counter(b for d in found for b in d[2]), Counter(b for x in target for b in runs(x)[1])
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(buckets)]
    out = []
    for i, n, f in found:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], -2**63 if r[0] is None else r[0], r[1]))
    for k, r in enumerate(fit[:percent * len(fit) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in out]


@pytest.mark.parametrize("max_run,buckets,piece", [(1, 10_000, 1 << 20), (1, 50, 64), (3, 100_000, 64)])
def test_resample(spark, docs, max_run, buckets, piece, monkeypatch):
    monkeypatch.setattr(importance.pieces, "__defaults__", (1, piece))
    monkeypatch.setattr(importance, "DICTIONARY", 60)
    target = [sentence(40), "New York, new york", None, ""]
    bench = spark.createDataFrame([(x, "c") for x in target], "text string, doc_id string")
    got = importance.resample(docs, bench, max_run=max_run, buckets=buckets, percent=60, least_words=8)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {f.dataType.simpleString() for f in got.schema} == {"bigint"}
    want = resampled(listed(docs, "doc_id", "text"), target, max_run, buckets, 60, 8)
    assert order(listed(got, "*")) == order(want)


def test_resample_of_empty_tables(spark, docs, empty):
    assert importance.resample(empty, empty).count() == 0
    got = importance.resample(docs, empty, least_words=1000)
    assert got.count() == docs.count() and got.where("rank IS NOT NULL").count() == 0


def test_composed_crc32():
    shift = importance.Shift()
    left = [bytes(RNG.randbytes(RNG.randint(0, 50))) for _ in range(200)]
    right = [bytes(RNG.randbytes(RNG.choice([0, 1, 7, 300, 70_000]))) for _ in range(200)]
    got = importance.compose(shift, np.array([zlib.crc32(x) for x in left], np.uint32), np.array([zlib.crc32(x) for x in right], np.uint32),
                             np.array([len(x) for x in right]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in zip(left, right)]


def mined(rows, support, best):
    f, n = Counter(), Counter()
    for lang, t in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (t or "").translate(FOLD)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    found = {x: a for x, a in f.items() if a >= support and len(x[1]) > 1}
    longer = Counter()
    for (lang, w), a in found.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                longer[lang, w[i:i + k]] = max(longer[lang, w[i:i + k]], a)
    out = {}
    for (lang, w), a in found.items():
        if longer[lang, w] < a:
            score, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return [(lang, r + 1, p.decode(), -a, x, y, n[lang], -s) for lang, v in out.items() for r, (s, a, p, x, y) in enumerate(sorted(v)[:best])]


@pytest.mark.parametrize("support,best,chunk,bits", [(3, 2000, 2 << 20, 1 << 26), (3, 9, 90, 1 << 26), (25, 2000, 90, 1 << 6)])
def test_phrases(spark, docs, support, best, chunk, bits, monkeypatch):
    monkeypatch.setattr(phrases.chunks, "__defaults__", (chunk,))
    monkeypatch.setattr(phrases, "MEMORY", 30)
    got = phrases.collocations(docs, support=support, best=best, bits=bits)
    want = mined(listed(docs, "lang", "text"), support, best)
    assert len(want) > 3
    assert sorted(listed(got, "*")) == sorted(want)
    assert {f.dataType.simpleString() for f in got.schema} == {"bigint", "string"}


def test_phrase_scores_beyond_64_bits(spark, monkeypatch):
    big = 3_000_000_000_000
    rows = [("en", 0, "", 5 * big), ("en", 1, "a", big + 1), ("en", 1, "b", big + 3), ("en", 2, "a b", big)]
    table = spark.createDataFrame(rows, "lang string, k int, phrase string, f long")
    monkeypatch.setattr(phrases, "frequent_phrases", lambda *_: table)
    docs = spark.createDataFrame([], DOCS)
    assert [r.score for r in phrases.collocations(docs).collect()] == [1000 * big * 5 * big // ((big + 1) * (big + 3))]


def test_words_of_one_hash_stay_apart():
    ids, at = np.array([1, 2, 1, 3, 1, 2]), np.array([0, 2, 4])
    for hashes in (np.zeros(3, np.uint64), np.array([5, 9, 5], np.uint64)):
        rows, counts = phrases._distinct(ids, at, hashes, 2)
        assert sorted(zip(rows.tolist(), counts.tolist())) == [([1, 2], 2), ([1, 3], 1)]


@pytest.mark.parametrize("recounted,most", [(300_000, 1), (4, 40)])
def test_recount_adds_up_over_the_slices_of_a_task(spark, recounted, most, monkeypatch):
    monkeypatch.setattr(phrases, "RECOUNTED", recounted)
    monkeypatch.setattr(phrases, "FRESH", 7)
    docs = spark.createDataFrame([(i, "a b c, é b", ["en", None][i % 2], "s", 1) for i in range(40)], DOCS).repartition(40)
    slices = phrases.numbered(docs, "text", "lang").coalesce(1)
    assert slices.count() > 20
    found = listed(phrases._recounted(slices, np.full(4, 2**64 - 1, np.uint64)), "lang", "k", "phrase", "f")
    times = Counter(x[:3] for x in found)
    total = Counter()
    for *x, f in found:
        total[tuple(x)] += f
    one = {(0, ""): 5, (1, "a"): 1, (1, "b"): 2, (1, "c"): 1, (1, "é"): 1, (2, "a b"): 1, (2, "b c"): 1, (2, "é b"): 1, (3, "a b c"): 1}
    assert total == {(lang, *x): 20 * n for lang in ("en", "und") for x, n in one.items()}
    assert max(times.values()) <= most


def test_phrases_of_an_empty_table(empty):
    assert phrases.collocations(empty).count() == 0
