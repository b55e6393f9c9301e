"""The corpus pipeline on a small fixture: every stage against a plain chain, and odd columns."""
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scorecraft.llm import line_dedup, mixing, near_dedup, quality

RNG = random.Random(31)
WORDS = ["".join(RNG.choice("abcdefgh") for _ in range(RNG.randint(2, 8))) for _ in range(500)]
COMMON = "this is one line that very many of the documents hold word for word"


def prose(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


def documents():
    rows = []
    for i in range(60):
        text = f"{prose(40)}\n{COMMON if i % 3 == 0 else prose(9)}\n{prose(25)}"
        rows.append((i, text, "en", ["a", "b", None][i % 3], len(text)))
    near = rows[5][1].split(" ")
    near[7] = "changed"
    rows += [(60, rows[4][1], "en", "a", rows[4][4]), (61, " ".join(near), "en", "b", 1), (62, None, None, None, None), (63, "", "en", "a", 0),
             rows[7], (None, prose(30), "en", "a", 5), (None, prose(31), "en", "a", 5)]
    return rows


ROWS = documents()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def after_lines(rows):
    """The rows without the lines of 40 or more code points that five or more documents hold."""
    low = -2**63
    has = defaultdict(set)
    for i, t, *_ in rows:
        for x in (t or "").split("\n"):
            if len(x.strip().lower()) >= 40:
                has[x.strip().lower()].add(low if i is None else i)
    keeper = {k: max(v) for k, v in has.items() if len(v) >= 5}
    out = []
    for i, t, *rest in rows:
        kept = [x for x in (t or "").split("\n") if keeper.get(x.strip().lower(), low if i is None else i) == (low if i is None else i)]
        out.append((i, t if t is None else "\n".join(kept), *rest))
    return out


def test_every_stage_works_on_what_its_predecessor_kept(spark, monkeypatch):
    from scorecraft.llm import align, words

    start = spark.createDataFrame(ROWS, SCHEMA)
    seen = {}

    def kept(df, name):
        df = spark.createDataFrame(df.collect(), df.schema)
        seen[name] = [tuple(r) for r in df.collect()]
        return df

    monkeypatch.setattr(corpus_pipeline, "staged", kept)
    monkeypatch.setattr(corpus_pipeline, "table", lambda s, d, name: start if name == "documents" else spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int"))
    packed = corpus_pipeline.run(spark, "nowhere").collect()
    assert list(seen) == [name for name, _ in corpus_pipeline.STAGES[:-1]]
    key = lambda rows: sorted(((r[0] is None, r[0], r[1] or "", r[2] or "", r[3] or "") for r in rows), key=repr)
    # with labels of one class every document is accepted
    assert key(seen["quality_filter"]) == key(ROWS)
    assert key(seen["line_dedup"]) == key(after_lines(seen["quality_filter"]))
    # one document of each class of all pairs; rows that repeat id and text are one
    rows = sorted(set((r[0], r[1] or "") for r in seen["line_dedup"]), key=lambda r: (r[0] is not None, r[0] or 0))
    hashed = [words.word_hashes(t.lower().encode()) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if align.similarity_at_least(hashed[i], hashed[j], 0.8):
                label[max(root(i), root(j))] = min(root(i), root(j))
    groups = defaultdict(set)
    for i, r in enumerate(rows):
        groups[root(i)].add(r)
    near = [(r[0], r[1] or "") for r in seen["near_dedup"]]
    assert len(near) == len(groups) and all(len([r for r in near if r in g]) == 1 for g in groups.values())
    # the mix takes words of what is there, by source near its target
    mixed = Counter()
    for _, t, _, source, _ in seen["source_mix"]:
        mixed[source] += len((t or "").split())
    want = {r["source"]: r["target"] for r in mixing.mix(spark.createDataFrame(seen["near_dedup"], SCHEMA)).join(
        spark.createDataFrame(seen["near_dedup"], SCHEMA), "doc_id").select("source", "target").distinct().collect()}
    assert set(mixed) <= set(want) and all(abs(mixed[s] - t) <= 0.05 * t + 60 for s, t in want.items())
    texts = {(r[0], r[1] or "") for r in seen["near_dedup"]}
    assert all(any(i == j and (t or "") in u for j, u in texts) for i, t, *_ in seen["source_mix"])
    # every row of the mix is packed without a gap
    assert len({r["doc_id"] for r in packed}) == len({r[0] for r in seen["source_mix"]})
    spans = defaultdict(list)
    for r in packed:
        spans[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in spans.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 4096


ODD = ["_id", "_th", "bitmap", "times", "a1", "b1", "a2", "b2", "node", "label", "size", "n", "_text", "r", "c0", "c1"]


@pytest.mark.parametrize("stage", [line_dedup.cleaned, mixing.mixed, near_dedup.representatives, lambda d: quality.accepted(d, 1.0)])
@pytest.mark.parametrize("chars", [True, False])
def test_stages_keep_columns_of_any_name(spark, stage, chars):
    rows = [r if chars else r[:4] for r in ROWS]
    docs = spark.createDataFrame([(*r, *[f"{x}-{r[0]}" for x in ODD]) for r in rows],
                                 (SCHEMA if chars else SCHEMA.replace(", n_chars long", "")) + "".join(f", {x} string" for x in ODD))
    got = stage(docs)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    found = got.collect()
    assert found and all(r[x] == f"{x}-{r['doc_id']}" for r in found for x in ODD)
    if chars and stage is line_dedup.cleaned:
        assert all(r["n_chars"] == len(r["text"]) for r in found if r["doc_id"] is not None and r["doc_id"] < 60 and r["doc_id"] % 3 == 0)
    assert stage(docs.limit(0)).count() == 0
    only = stage(docs.where(F.col("doc_id").isNull() | (F.col("doc_id") == 62))).collect()
    assert {r["doc_id"] for r in only} <= {None, 62}
