"""Exact areas under many ROC curves from one narrow shuffle.

Every row has a score of each model of its fold. Scores are dealt to buckets by edges
drawn from a sample (the edges decide how the work is cut, never the result); a task
sorts the scores it has and sends, for a curve, a bucket and a class, one row with the
values as offsets of 4 bytes where they lie close together. A bucket then counts the
pairs of its own, and pairs of different buckets follow from the buckets' totals.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SCORE_DP = 10  # decimals of a score
BUCKET_ROWS, FEW_ROWS, BUCKETS = 200_000, 2_000, 64  # of a curve: rows of a bucket at most and at least, buckets if both allow
SAMPLE_ROWS, HELD = 100_000, 2_000_000  # rows that edges are drawn from, scores that a task sorts together


def packed(values: np.ndarray) -> tuple[float, bool, bytes, bytes]:
    """(base, wide, values, counts) of sorted scores: distinct ones, as offsets from the base
    in units of the last decimal if they fit 32 bits, and how often each comes unless all come once."""
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    counts = b"" if len(first) == len(values) else np.diff(np.r_[first, len(values)]).astype(np.int64).tobytes()
    values = values[first]
    steps = np.rint(values * 10.0**SCORE_DP)
    if max(abs(steps[0]), abs(steps[-1])) < 2**52 and steps[-1] - steps[0] < 2**32:
        return float(steps[0]), False, (steps - steps[0]).astype(np.uint32).tobytes(), counts
    return 0.0, True, values.tobytes(), counts


def unpacked(base: float, wide: bool, values: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(distinct scores, how often) as ``packed`` took them."""
    got = np.frombuffer(values) if wide else (np.frombuffer(values, np.uint32) + base) / 10.0**SCORE_DP
    return got, np.frombuffer(counts, np.int64) if counts else np.ones(len(got), np.int64)


_COLUMNS = "cell int, bucket int, positive boolean, base double, wide boolean, values binary, counts binary"
_SCHEMA = pa.schema([("cell", pa.int32()), ("bucket", pa.int32()), ("positive", pa.bool_()), ("base", pa.float64()), ("wide", pa.bool_()),
                     ("values", pa.binary()), ("counts", pa.binary())])


def _pieces(held: list, edges: dict[int, np.ndarray], folds: int) -> pa.RecordBatch:
    z, pos, fold = (np.concatenate(x) for x in zip(*held))
    out = []
    for f in np.unique(fold):
        mine = np.flatnonzero(fold == f)
        t = pos[mine]
        for g in range(z.shape[1]):
            cell, v = g * folds + int(f), z[mine, g]
            order = np.argsort(v, kind="stable")
            v, p = v[order], t[order]
            at = [0, *np.searchsorted(v, edges.get(cell, np.zeros(0)), side="left"), len(v)]
            for bucket, (a, b) in enumerate(zip(at, at[1:])):
                for positive in (True, False):
                    if b > a and len(part := v[a:b][p[a:b] == positive]):
                        out.append((cell, bucket, positive, *packed(part)))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SCHEMA)], schema=_SCHEMA)


def _counted(table: pa.Table) -> pa.Table:
    sides = {True: ([], []), False: ([], [])}
    for r in table.to_pylist():
        for held, got in zip(sides[r["positive"]], unpacked(r["base"], r["wide"], r["values"], r["counts"])):
            held.append(got)
    (pv, pn), (nv, nn) = ([np.concatenate([np.zeros(0, t), *x]) for x, t in zip(sides[s], (float, np.int64))] for s in (True, False))
    distinct, at = np.unique(np.concatenate([pv, nv]), return_inverse=True)
    p, n = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
    np.add.at(p, at[:len(pv)], pn)
    np.add.at(n, at[len(pv):], nn)
    twice = int((p * (2 * np.cumsum(n) - n)).sum())
    one = table.slice(0, 1)
    return pa.table({"cell": one.column("cell"), "bucket": one.column("bucket"), "twice": pa.array([twice], pa.int64()),
                     "p": pa.array([int(p.sum())], pa.int64()), "n": pa.array([int(n.sum())], pa.int64())})


def roc_areas(rows: DataFrame, scores: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]], folds: int,
              bucket_rows: int = BUCKET_ROWS, few: int = FEW_ROWS, held: int = HELD) -> dict[int, tuple[float, int, int]]:
    """{cell: (area x positives x negatives, positives, negatives)}, ties counted half.

    ``scores`` gives of a batch the scores (rows x models, rounded to ``SCORE_DP``), whether
    each row is positive, and its fold; the cell is model x folds + fold.
    """
    total = rows.count()
    per = total / max(folds, 1)
    buckets = max(1, min(BUCKETS, math.ceil(per / few)), math.ceil(per / bucket_rows))
    edges: dict[int, np.ndarray] = {}
    if buckets > 1:
        wanted = max(SAMPLE_ROWS, 20 * folds * buckets)
        sample = [scores(b) for b in rows.sample(min(1.0, wanted / total), 1).toArrow().to_batches() if b.num_rows]
        if sample:
            z, _, fold = (np.concatenate(x) for x in zip(*sample))
            for f in np.unique(fold):
                ends = np.quantile(z[fold == f], np.arange(1, buckets) / buckets, axis=0)
                edges |= {g * folds + int(f): np.unique(ends[:, g]) for g in range(z.shape[1])}

    def run(batches):
        have, size = [], 0
        for b in batches:
            if b.num_rows:
                have.append(scores(b))
                size += have[-1][0].size
            if size >= held:
                yield _pieces(have, edges, folds)
                have, size = [], 0
        if have:
            yield _pieces(have, edges, folds)

    found = rows.mapInArrow(run, _COLUMNS).groupBy("cell", "bucket").applyInArrow(_counted, "cell int, bucket int, twice long, p long, n long").collect()
    out: dict[int, tuple[int, int, int]] = {}
    for r in sorted(found, key=lambda r: (r["cell"], r["bucket"])):
        twice, p, n = out.get(r["cell"], (0, 0, 0))
        out[r["cell"]] = (twice + r["twice"] + 2 * r["p"] * n, p + r["p"], n + r["n"])
    return {c: (twice / 2, p, n) for c, (twice, p, n) in out.items()}
