"""The ten operators against brute force, and on odd inputs."""
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scorecraft.llm import (align, chat, crf, html_extract, line_dedup, mixing, near_dedup, packing, quality, simhash,
                            substring_dedup, suffix, topk)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
RNG = random.Random(5)
WORDS = ["".join(RNG.choice("abcdefghij") for _ in range(RNG.randint(2, 9))) for _ in range(400)]


def sentence(n=12):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


SHARED, PASSAGE = sentence(12), sentence(60)
LONG = "\n".join(sentence(40) for _ in range(150))
TEXTS = ([f"{sentence(30)}\n{SHARED}\n{sentence(8)}\n  {SHARED.upper()}\t" for _ in range(9)]
         + [f"{sentence(20)} {PASSAGE} {sentence(20)}" for _ in range(6)]
         + [LONG, LONG, LONG.replace(" a", " zz", 3), None, "", " \n\t", "x", "naïve café – ÀÉ", "=" * 900, "ab" * 400])


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", ["b", None, "a"][i % 3], len(t or "")) for i, t in enumerate(TEXTS)]
    rows += [rows[0], rows[0], (None, "no id " + PASSAGE, "en", "a", 5), (3, "other text, same id", "en", "b", 3)]
    return spark.createDataFrame([(*r, "e", 1) for r in rows], DOCS + ", node string, size int")  # clashing names


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def local(docs):
    return [(r["doc_id"], r["text"] or "", r["source"]) for r in docs.collect()]


def test_line_dedup(docs, empty):
    low = -(2**63)
    rows = [(low if i is None else i, t) for i, t, _ in local(docs)]
    strip = " \t\n\x0b\x0c\r"
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(strip).translate(fold)
    has = defaultdict(set)
    for i, t in rows:
        for x in t.split("\n"):
            if len(key(x)) >= 40:
                has[key(x)].add(i)
    gone = {k: max(v) for k, v in has.items() if len(v) >= 5}
    want = Counter()
    for i, t in rows:
        lines = t.split("\n")
        kept = [x for x in lines if gone.get(key(x), i) == i]
        want[(i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())] += 1
    got = Counter((low if r["doc_id"] is None else r["doc_id"], *r[1:]) for r in line_dedup.digest(line_dedup.dedup_lines(docs)).collect())
    assert got == want and sum(v for k, v in want.items() if k[2]) >= 8
    assert line_dedup.dedup_lines(empty).count() == 0
    cleaned = line_dedup.cleaned(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == len(rows)


def test_mixing(docs, empty):
    got = mixing.mix(docs).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()), key=str)
    rows = local(docs)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.encode().split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = dict(zip(order, mixing.targets([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))], 1.5 * sum(sizes.values()), 2)))
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))
    taken = Counter()
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["target"]] += r["taken"]
    assert len(got) == len(rows)
    for s in order:
        assert target[s] <= 2 * sizes[s] + 1e-9 and abs(taken[target[s]] - target[s]) <= 40
    assert mixing.mix(empty).count() == 0
    out = mixing.mixed(docs)
    words = sum(len(r["text"].encode().split()) for r in out.collect())
    assert out.columns == docs.columns and words == pytest.approx(1.5 * sum(len(t.encode().split()) for _, t in {(i, t) for i, t, _ in rows}), rel=0.03)


def test_sainte_lague_is_highest_quotients():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = rng.integers(1, 9)
        w, caps, seats = rng.integers(0, 50, n).astype(float), rng.integers(0, 12, n), int(rng.integers(0, 40))
        want = np.zeros(n, int)
        for _ in range(seats):
            q = [w[i] / (2 * want[i] + 1) if want[i] < caps[i] and w[i] > 0 else -1 for i in range(n)]
            if max(q) < 0:
                break
            want[int(np.argmax(q))] += 1
        got = mixing.sainte_lague(w, seats, caps)
        assert got.sum() == want.sum() and (got <= caps).all()
        assert sorted(w / (2 * got + 1)) == pytest.approx(sorted(w / (2 * want + 1)))


def test_simhash(docs, empty, spark):
    rows = sorted(((-(2**63) if r["doc_id"] is None else r["doc_id"]), r["h"], r["text"] or "")
                  for r in docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect())
    want = Counter()
    for n, (i, _, t) in enumerate(rows):
        e = simhash.edited(t, rows[(n + 1) % len(rows)][2])
        want[(i, len(t), hashlib.sha256(e.encode()).hexdigest(), simhash.fingerprint(t.encode()).hex(), simhash.fingerprint(e.encode()).hex())] += 1
    got = Counter((-(2**63) if r["doc_id"] is None else r["doc_id"], *r[1:5]) for r in simhash.edit_report(docs).collect())
    assert got == want
    assert simhash.edit_report(empty).count() == 0
    fps = simhash.fingerprints(docs)
    base = simhash.fingerprint(LONG.encode())
    q = spark.createDataFrame([(bytearray(base),)], "fingerprint binary")
    near = bytes([base[0] ^ 1, *base[1:-1], base[-1] ^ 128])
    found = simhash.within_radius(q, fps.select("fingerprint").union(spark.createDataFrame([(bytearray(near),)], "fingerprint binary"))).collect()
    have = {bytes(r["fingerprint"]) for r in fps.collect()} | {near}
    assert {(bytes(r["fingerprint"]), r["distance"]) for r in found} == {
        (f, d) for f in have if (d := round((1 - simhash.likeness(f, base)) * 256)) <= simhash.RADIUS}


def test_packing(docs, empty):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.tokenizer_path())
    want = Counter()
    for i, t, _ in local(docs):
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 1], "<u4")
        for p in range(0, len(ids), 4096):
            want[(i, p // 4096, p, len(ids[p:p + 4096]), zlib.crc32(ids[p:p + 4096].tobytes()))] += 1
    out = packing.packed(docs).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    seqs = defaultdict(list)
    for r in out:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in seqs.values():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:k]) for k in range(len(s))] and sum(n for _, n in s) <= 4096
    assert len(seqs) == -(-sum(r["length"] for r in out) // 4096)
    assert packing.packed(empty).count() == 0
    whole = packing.sequences(docs.where("doc_id = 22")).first()
    assert whole["ids"] == [*tok.encode(TEXTS[22], add_special_tokens=False).ids, 1] and whole["doc_ids"] == [22]


def test_encoder_equals_the_tokenizer():
    enc = packing.Encoder(packing.tokenizer_path())
    rng = random.Random(2)
    bits = ["a", "B", "é", "İ", "ſ", "K", "'s", "'T", ".", ",", "!", "<|endoftext|>", "1", "Σ", "́", " ", "\n", "\t", "日", "ß", "\x1c", "\xa0"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + ["a" * 300 + ". b", ""]
    want = [np.array(e.ids, "<u4").tobytes() for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert enc.encode(texts) == want


def test_token_ids_are_gathered_from_distinct_pieces():
    enc = packing.Encoder(packing.tokenizer_path())
    letters = [chr(c) for c in range(0x41, 0x250) if chr(c).isalpha()]
    texts = [f"{x}{y}{m} a{x.lower()}{m}{m}" for x in letters for y in ("", "B", "z") for m in ("", ".", ":")] + ["", "A" * 5000 + ".\n a"]
    sent = []
    plain = enc._plain
    enc._plain = lambda words: plain(sent.append(words) or words)
    ids, edge = enc.token_ids(pa.array(texts * 3))
    want = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)] * 3
    assert [ids[a:b].tolist() for a, b in zip(edge, edge[1:])] == want
    assert len(sent) == 1 and len(set(sent[0])) == len(sent[0])  # once each, whatever case, mark or text it has
    ids, edge = enc.token_ids(pa.array([], pa.string()))
    assert len(ids) == 0 and edge.tolist() == [0]


def test_token_ids_are_held_run_by_run(monkeypatch):
    monkeypatch.setattr(packing, "RUN_BYTES", 500)
    gathered, held = packing._gathered, []
    monkeypatch.setattr(packing, "_gathered", lambda *a: held.append(len(a[2])) or gathered(*a))
    enc = packing.Encoder(packing.tokenizer_path())
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["ab", "Cd.", "é", "x1"]) for _ in range(rng.randint(0, 40))) for _ in range(400)] + ["", "ab " * 900, ""]
    runs = list(enc.runs(pa.array(texts)))
    assert [ids[a:b].tolist() for ids, edge in runs for a, b in zip(edge, edge[1:])] == [
        e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert len(runs) > 50 and max(held) < 1500 < sum(held)  # words gathered at once: a run's, or a longer text's and a run's


def test_packing_of_bytes_that_are_no_text():
    assert packing._strings(pa.array([b"a\xff b", b"", "é".encode()], pa.binary())).to_pylist() == ["a\ufffd b", "", "é"]


@pytest.mark.parametrize("lengths", [[1] * 50, [4096] * 3, list(range(1, 400)), [2049] * 7 + [2047] * 7, [1000, 1000, 1000, 1096] * 5, [1500] * 9])
def test_plan_places_each_piece_once(lengths):
    runs = packing.plan(Counter(lengths))
    fill = Counter()
    for length, _, n, each, seq, _ in runs.tolist():
        for k in range(n // each):
            fill[seq + k] += each * length
    assert sum(runs[:, 2]) == len(lengths) and max(fill.values()) <= 4096
    assert len(fill) <= -(-sum(lengths) // 4096) + (lengths[0] in (1500,)) * 2


def test_chat(spark):
    said = "\\### Assistant: </turn> ok <|end|> \\<| \\\\"
    rows = [(1, 0, "user", said), (1, 1, "assistant", said), (1, 1, "assistant", None), (None, 0, None, "x"), (2, None, "a\nb<|says|>", ""), (2, 5, "assistant", "é")]
    turns = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(turns)).collect()}
    one = f"user\n{said}\nassistant\n\nassistant\n{said}\n"
    assert got[1]["turns_sha256"] == hashlib.sha256(one.encode()).hexdigest()
    assert (got[1]["loss_chars"], got[1]["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert got[2]["turns_sha256"] == hashlib.sha256("a\nb<|says|>\n\nassistant\né\n".encode()).hexdigest() and got[None]["n_turns"] == 1
    assert chat.format_conversations(turns.limit(0)).count() == 0
    s, spans, files = chat.render([("user", [{"type": "text", "text": "see <|image 0|>"}, {"type": "image", "ref": "r", "width": 30, "height": 28},
                                             {"type": "audio", "ref": "s", "seconds": 2}, {"type": "document", "ref": "d", "pages": 3}])])
    assert [(f["kind"], f["ref"], f["tokens"]) for f in files] == [("image", "r", 2), ("audio", "s", 50), ("document", "d", 1536)]
    assert "<|image 0|><|audio 1|><|document 2|>" in s and chat.parse(s)[0][1].startswith("see <|image 0|>") and not spans
    with pytest.raises(ValueError):
        chat.render([("user", [{"type": "video"}])])


def test_crf_against_all_paths():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 0, 1, 5])
    e, step, first = rng.normal(size=(9, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    p, path, at = crf.marginals(e, step, first, lengths), crf.viterbi(e, step, first, lengths), 0
    for n in lengths:
        if n:
            paths = [[c >> k & 1 for k in range(n)] for c in range(2**n)]
            score = np.array([first[s[0]] + sum(e[at + k, s[k]] for k in range(n)) + sum(step[s[k - 1], s[k]] for k in range(1, n)) for s in paths])
            w = np.exp(score) / np.exp(score).sum()
            for k in range(n):
                assert p[at + k, 1] == pytest.approx(sum(x for x, s in zip(w, paths) if s[k]))
            assert path[at:at + n].tolist() == paths[int(score.argmax())]
        at += n


def test_quality(docs, empty, spark):
    good = [(100 + i, f"{sentence(14).capitalize()}.\n{sentence(9).capitalize()}.", "en", "a", 0) for i in range(120)]
    bad = [(300 + i, " ".join(f"{w.upper()}!!$$" for w in sentence(20).split()), "en", "a", 0) for i in range(120)]
    both = spark.createDataFrame(good + bad, DOCS)
    labels = spark.createDataFrame([(r[0], int(r[0] < 300), None) for r in good + bad] + [(None, 1, 1), (7, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(both, labels).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert all(r["predicted"] == (r["doc_id"] < 300) for r in got)
    model = quality.fit(both, labels)
    odd = quality.scored(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert quality.accepted(both, model).count() == 120
    assert quality.classify(empty, labels).count() == 0 and quality.fit(both, labels.limit(0)) == 1.0


def test_topk(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(320, 6)) * rng.uniform(0.05, 3, 320)[:, None])]
    rows += [(i, rows[9][1]) for i in range(400, 520)] + [(900, None), (901, [float("nan")] * 6), (902, [1.0, None]), (700, [0.5, 2.0]), (None, [1.0]), rows[3]]
    vectors = topk.scaled(spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, v int"))
    mp = pytest.MonkeyPatch()
    mp.setattr(topk, "BUCKET_ROWS", 50)
    mp.setattr(topk, "BLOCK_ROWS", 2)
    got = sorted(map(tuple, topk.top_k(vectors.where("vec_id % 100 = 0"), vectors).collect()))
    mp.undo()
    ok = {i: np.floor(1024 * np.array([*v, *[0.0] * (6 - len(v))])).astype(int) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()}
    want = []
    for q in ok:
        if q % 100 == 0:
            best = sorted((-int(ok[q] @ ok[c]), c) for c in ok if c != q)[:10]
            want += [(q, n, c, -s) for n, (s, c) in enumerate(best, 1)]
    assert got == sorted(want)
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def _axis_vectors(kind, rng, n=400):
    if kind == "one-hot":
        return np.eye(5)[rng.integers(0, 5, n)] * rng.uniform(0.2, 3, n)[:, None]
    if kind == "dominant":
        return np.c_[rng.uniform(0.5, 3, n) * rng.choice([-1, 1], n), rng.normal(size=(n, 4)) * 0.2]
    return rng.normal(size=(n, int(kind))) * rng.uniform(0.05, 3, n)[:, None]


@pytest.mark.parametrize("kind", ["1", "2", "3", "one-hot", "dominant"])
def test_topk_cell_near_an_axis(kind):
    rng = np.random.default_rng(6)
    v = np.floor(1024 * _axis_vectors(kind, rng)).astype(np.int64)
    v = v[np.argsort(-(v.astype(float) ** 2).sum(1), kind="stable")]
    ids = rng.permutation(len(v))
    scores = v @ v.T
    for share in (0.9, 0.7, 0.5):  # from steep thresholds to flat ones
        theta = np.floor(share * scores.max(1)).astype(float)
        got = {(a, b, s) for q, c, x in topk.search_cell(ids, v, theta, ids, v, len(v)) for a, b, s in zip(q, c, x)}
        want = {(ids[i], ids[j], scores[i, j]) for i in range(len(v)) for j in range(len(v)) if i != j and scores[i, j] >= theta[i]}
        assert got == want


def test_topk_near_an_axis_over_many_buckets(spark, monkeypatch):
    rng, rows = np.random.default_rng(7), []
    for kind in ("1", "2", "3", "one-hot", "dominant"):
        rows += [[float(x) for x in v] for v in _axis_vectors(kind, rng, 120)]
    vectors = topk.scaled(spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>"))
    monkeypatch.setattr(topk, "BUCKET_ROWS", 60)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 100)
    got = Counter(map(tuple, topk.top_k(vectors, vectors).collect()))
    m = np.floor(1024 * np.array([[*v, *[0.0] * (5 - len(v))] for v in rows])).astype(int)
    scores, want = m @ m.T, Counter()
    for q in range(len(m)):
        best = sorted((-int(scores[q, c]), c) for c in range(len(m)) if c != q)[:10]
        want.update((q, n, c, -s) for n, (s, c) in enumerate(best, 1))
    assert got == want


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(1)
    for _ in range(60):
        data, depth = rng.integers(97, 97 + rng.integers(1, 4), rng.integers(1, 300)).astype(np.uint8), int(rng.integers(3, 60))
        sa, b = suffix.suffix_array(data, depth), data.tobytes()
        lcp = suffix.common_prefixes(data, sa, depth)
        for i in range(1, len(sa)):
            x, y = b[sa[i - 1]:], b[sa[i]:]
            k = next((n for n, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
            assert x[:depth] <= y[:depth] and min(k, depth) == min(lcp[i], depth)


@pytest.mark.parametrize("split", [4000, 2])
def test_substring_dedup(docs, empty, split, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SPLIT", split)
    rows = [(i, t.encode()) for i, t, _ in local(docs)]
    count = Counter(t[k:k + 200] for _, t in rows for k in range(len(t) - 199))
    want = Counter()
    for i, t in rows:
        gone = np.zeros(len(t) + 1, int)
        for k in range(len(t) - 199):
            if count[t[k:k + 200]] > 1:
                gone[k:k + 200] = 1
        kept = bytes(c for c, g in zip(t, gone) if not g)
        want[(i, len(t), len(t) - len(kept), int((np.diff(np.r_[0, gone]) == 1).sum()), hashlib.sha256(kept).hexdigest())] += 1
    assert Counter(map(tuple, substring_dedup.digest(substring_dedup.dedup_substrings(docs)).collect())) == want
    assert substring_dedup.dedup_substrings(empty).count() == 0


def test_html():
    page = html_extract.blocks
    assert [b.text for b in page("<p>a &amp; b<p>c<br>d&nbsp;e<script>x<p></script><!-- <p>no --><ul><li>1<li>2</ul>tail &am")] == ["a & b", "c d e", "1", "2", "tail &am"]
    assert page("") == [] and [b.text for b in page("<head><title>t</title><body>x")] == ["x"]


def test_html_raw_elements_end_with_themselves():
    texts = lambda page: [b.text for b in html_extract.blocks(page)]
    for open_ in ("<svg-icon></svg-icon>", "<select-menu>", "<title-bar></title-bar>", '<svg width="1"/>', "<svg/>", "<math/>",
                  "<svg viewBox=x>", "<select>", "<object data=x>", "<template>", "<script-box></script-box>"):
        assert texts(f"<article>{open_}<p>all the text</p></article><p>more") == ["all the text", "more"], open_
    assert texts("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds<object><p>fallback</p></object>") == ["so x=2 holds", "fallback"]
    for tag in ("svg", "title", "template", "select", "noscript", "iframe", "textarea", "canvas", "script", "style"):
        assert texts(f"<p>a</p><{tag} class='x'>gone<p>gone</{tag.upper()} ><p>b") == ["a", "b"], tag
    assert texts("<p>a<script>gone<p>gone") == ["a"]
    assert len(texts("<p>a<select>" * 20_000)) == 20_000


def test_html_model(spark):
    rng, said = random.Random(3), [sentence(14).capitalize() + "." for _ in range(60)]
    body = lambda: "".join(f"<p>{rng.choice(said)} {rng.choice(said)}</p>" for _ in range(4))
    pages = [(i, f"u{i}", f"<html><body><nav><ul><li><a href=x>{rng.choice(WORDS)}</a></li></ul></nav><div class=ad>{rng.choice(said)}</div>"
              f"<article><h1>{sentence(5)}</h1>{body()}</article><footer>&copy; {sentence(3)}</footer></body></html>") for i in range(40)]
    df = spark.createDataFrame([(*p, 1) for p in pages + [(None, None, None), (41, "e", ""), pages[0]]], "page_id long, url string, html string, text int")
    got = html_extract.extract(df).collect()
    assert len(got) == 43 and all(r["n_chars"] == len(r["text"]) for r in got)
    for r in got:
        if r["page_id"] is not None and r["page_id"] < 40:
            inner = pages[r["page_id"]][2].split("<article>")[1].split("</article>")[0]
            assert r["text"] == "\n\n".join(b.text for b in html_extract.blocks(inner))
        else:
            assert r["text"] == ""
    model = html_extract.fit(df)
    right = total = 0
    for _ in range(60):  # layouts it has not seen
        blocks = html_extract.blocks(html_extract.layout(said, rng), html_extract.MARK)
        path = crf.viterbi(model.scores(html_extract.features(blocks)), model.step, model.first, np.array([len(blocks)]))
        right += sum(int(y) == (b.label or 0) for y, b in zip(path, blocks))
        total += len(blocks)
    assert right > 0.97 * total
    assert html_extract.extract(df.limit(0)).count() == 0


def _article_pages(paragraph, n, heading, menu):
    return [(i, f"<html><body><nav><ul><li><a href=x>{menu}</a></li></ul></nav><article><h1>{heading}</h1>"
             f"{''.join(f'<p>{paragraph()}</p>' for _ in range(n))}</article><footer>&copy; {menu}</footer></body></html>") for i in range(12)]


@pytest.mark.parametrize("kind", ["long", "unspaced", "short"])
def test_html_pages_of_any_length_and_script(spark, kind):
    rng = random.Random(12)
    signs = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n))
    pages = {"long": lambda: _article_pages(lambda: sentence(40).capitalize() + ".", 300, sentence(5), WORDS[0]),
             "unspaced": lambda: _article_pages(lambda: signs(70) + "。", 5, signs(8), signs(2)),
             "short": lambda: _article_pages(lambda: rng.choice(["yes.", "no no.", "ok."]), 4, "a b", "x")}[kind]()
    assert kind != "long" or min(len(p) for _, p in pages) > 20_000
    df = spark.createDataFrame([(i, "u", p) for i, p in pages], "page_id long, url string, html string")
    for r in html_extract.extract(df).collect():
        inner = html_extract.blocks(pages[r["page_id"]][1].split("<article>")[1].split("</article>")[0])
        found = r["text"].split("\n\n")
        assert sum(b.text in found for b in inner) >= (0.95 if kind != "short" else 0.6) * len(inner)


def test_alignment_against_dynamic_programming():
    rng = np.random.default_rng(0)
    for _ in range(300):
        a = rng.integers(0, 6, rng.integers(0, 20)).astype(np.uint64)
        b = np.delete(np.r_[a, rng.integers(0, 6, 3)], rng.integers(0, len(a) + 3)).astype(np.uint64)
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        for most in (0, 2, 5, 20):
            assert align.distance_within(a, b, most) == (row[-1] if row[-1] <= most else None)


def test_near_dedup(docs, empty, spark):
    rng, rows = random.Random(8), []
    for g in range(12):  # groups of near copies, some of them large, and single texts
        base = sentence(80).split()
        for c in range([1, 2, 5, 40][g % 4]):
            words = base[:]
            for _ in range(rng.randint(0, 4) if c else 0):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            rows.append((1000 * g + c, " ".join(words), "en", "a", 0))
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {i: i // 1000 * 1000 for i, *_ in rows}
    odd = near_dedup.near_duplicates(docs).collect()
    by = defaultdict(set)
    for r in odd:
        by[r["class_id"]].add(r["doc_id"])
    assert len(odd) == docs.count() and by[15] == {15, 16, 17} and {18, 19, 20} <= by[18]
    kept = near_dedup.representatives(docs)
    assert kept.columns == docs.columns and kept.where("doc_id in (15, 16, 17)").count() == 1 and kept.where("doc_id = 0").count() == 1
    assert near_dedup.near_duplicates(empty).count() == 0


def _classes_by_all_pairs(texts):
    """The least place of each text's class, from all pairs."""
    words = [np.array([zlib.crc32(w.encode()) for w in t.lower().split()], np.uint64) for t in texts]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if align.similarity_at_least(words[i], words[j], 0.8):
                label[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(texts))]


def _substituted(words, n, rng):
    """``words`` with n of them replaced at even distances."""
    out = list(words)
    for k in range(n):
        out[int((k + 0.5) * len(out) / n)] = f"new{rng.randrange(10**9)}"
    return " ".join(out)


def _near_classes(spark, texts):
    got = near_dedup.near_duplicates(spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], DOCS)).collect()
    return [r["class_id"] for r in sorted(got, key=lambda r: r["doc_id"])]


def test_near_dedup_among_boilerplate(spark):
    rng, texts = random.Random(21), []
    shared = [f"all{i}" for i in range(155)]
    own = lambda n: [f"own{rng.randrange(10**9)}" for _ in range(n)]
    for g in range(150):  # texts that share 155 of 200 words; every fifth has a near copy, 18 of 45 own words replaced
        mine = own(45)
        texts.append(" ".join(shared + mine))
        if g % 5 == 0:
            texts.append(" ".join(shared) + " " + _substituted(mine, 18, rng))
    want = _classes_by_all_pairs(texts)
    assert len(set(want)) == 150 and _near_classes(spark, texts) == want


def test_prefixes_meet_every_partner():
    rng = np.random.default_rng(5)
    for _ in range(3000):
        a = rng.integers(0, 2**60, rng.integers(1, 80)).astype(np.uint64)
        b = a.copy()
        for _ in range(rng.integers(0, 8)):
            i = rng.integers(0, len(b) + 1)
            b = [np.insert(b, i, rng.integers(0, 2**60)), np.delete(b, min(i, len(b) - 1)) if len(b) > 1 else b, np.r_[b[:i], b[:1], b[i + 1:]]][rng.integers(0, 3)].astype(np.uint64)
        if np.array_equal(a, b) or not align.similarity_at_least(a, b, 0.8):
            continue
        keys = []
        for x in (a, b):
            keys.append({g for k, first, _ in near_dedup.prefixes(len(x), 0.8) for g in sorted(near_dedup.labelled_kmers(x, k).tolist())[:first]})
        assert len(keys[0] & keys[1]) >= min(shared for x in (a, b) for *_, shared in near_dedup.prefixes(len(x), 0.8))


def test_near_dedup_finds_all_pairs_just_above_the_bound(spark):
    rng, texts, pairs = random.Random(22), [], []
    own = lambda n: [f"own{rng.randrange(10**9)}" for _ in range(n)]
    for n in [*range(4, 13), 20, 40, 60, 100, 200] * 6:
        words = own(n)
        texts.append(" ".join(words))
        if n == 4:
            texts.append(" ".join([*words[:2], "in", *words[2:]]))
        else:
            texts.append(_substituted(words, rng.randint(max(1, int(0.15 * n)), int(0.2 * n + 1e-9)), rng))
        pairs.append((len(texts) - 2, len(texts) - 1))
    want, got = _classes_by_all_pairs(texts), _near_classes(spark, texts)
    assert all(want[a] == want[b] for a, b in pairs)
    found = sum(got[a] == got[b] for a, b in pairs)
    assert (found, len(pairs)) == (84, 84) and got == want
