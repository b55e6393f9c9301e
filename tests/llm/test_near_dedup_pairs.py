"""Pairs of the exact path: texts that stand alone are paired by the count of their own k-mers."""
import numpy as np
import pytest

pytest.importorskip("scorecraft.llm")
import pyarrow as pa  # noqa: E402

from scorecraft.llm import near_dedup as N  # noqa: E402
from scorecraft.sources import io  # noqa: E402


def test_meetings_tell_which_nodes_stand_alone():
    rows = [(1, 11, 0), (1, 12, 7), (2, 12, 7), (2, 13, 7), (3, 11, 0), (3, 14, 0)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["g", "name", "label"])
    got = [r for x in N._meetings([batch]) for r in zip(*(x[c].tolist() for c in ("g", "name", "label", "alone")))]
    assert got == [(1, 11, 11, True), (1, 12, 7, False), (3, 11, 11, True), (3, 14, 14, True)]


def test_pairs_of_single_texts_and_of_groups_are_all_found(spark):
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(400)]

    def changed(t, n):
        t = list(t)
        for i in rng.choice(len(t), n, replace=False):
            t[i] = f"x{rng.integers(10**9)}"
        return t

    base = [list(rng.choice(words, 40)) for _ in range(12)]
    texts = [t for b in base for t in (b, changed(b, 8))]  # a copy at 0.8 of each
    texts += [changed(base[0], 1) for _ in range(6)]  # that of the first has a group to be found by
    rows = spark.createDataFrame([(i, " ".join(t), "en", "a", 0) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(rows, elections=1).collect()}
    assert all(got[2 * i] == got[2 * i + 1] == 2 * i for i in range(12)) and {got[24 + i] for i in range(6)} == {0}


def test_a_written_stage_releases_its_shuffles(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(io, "release", lambda s: seen.append(s))
    assert io.save_stage(spark.range(20).repartition(3), "released").count() == 20 and len(seen) == 1
