"""Exact top-k inner products (operator 7) by norm-bucketed retrieval.

Candidates are range-partitioned by length (norm), longest first, into buckets
of bounded size; queries are cut into blocks of bounded size. The longest
bucket is searched first and gives every query a first threshold, the k-th best
score found there. Every other (query block, bucket) cell then prunes by it:
with |q| and the bucket's longest vector l, a candidate must reach the local
cosine threshold t = theta / (|q| l). Above 1 the bucket is skipped; a high t
prunes by coordinates (the feasible interval of the query's strongest
coordinates), a low one by length alone. Survivors are verified by their exact
integer products, so nothing is lost. Each cell returns at most k rows a query.

A candidate goes to as many cells as there are query blocks and a query to as
many as there are buckets; no cell holds more than ``BUCKET_ROWS`` candidates
and ``BLOCK_ROWS`` queries. Equal vectors stay even: buckets are cut by (norm,
vec_id). Products are exact below 2**63.

Defined cases: a vector that is null, or holds a null or non-finite component,
takes no part; vectors of different lengths are compared as if the shorter were
padded with zeros; rows that repeat a vec_id count once (the least vector);
rows with a null vec_id take no part; ties go to the smaller vec_id; fewer than
k candidates give fewer rows; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorecraft.llm.common import staged

BUCKET_ROWS = 4096
BLOCK_ROWS = 512
STEEP = 0.75  # from this local threshold on, coordinates prune better than length alone
COORDINATES = 4
SLACK = 1e-9

FOUND = "query_id long, vec_id long, score long"


def scaled(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 1024) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component, one row per id."""
    x = F.col(embedding).cast("array<double>")
    sound = F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & ~F.exists(
        x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.where(sound).select(F.col(vec_id).cast("long").alias("vec_id"),
                                       F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    m = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        m[i, :len(v)] = v
    return m


def _products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * max(1, queries.shape[1])
    if most < 2**53:  # doubles hold every partial sum exactly
        return (queries.astype(float) @ candidates.astype(float).T).astype(np.int64)
    return queries @ candidates.T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        place = np.flatnonzero(scores >= least)
    else:
        place = np.arange(len(scores))
    return place[np.lexsort((ids[place], -scores[place]))[:k]]


def search_cell(q_ids, q, theta, c_ids, c, k: int, prune: bool = True) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Top k of one cell. ``theta``: for each query the least score worth returning,
    or -inf. ``c`` is sorted by length, longest first."""
    out = []
    length, q_length = np.sqrt((c.astype(float) ** 2).sum(1)), np.sqrt((q.astype(float) ** 2).sum(1))
    unit = c / np.maximum(length, 1e-300)[:, None]
    longest = length.max(initial=0)
    whole = np.zeros(len(q), bool)
    picks: dict[int, np.ndarray] = {}
    for i in range(len(q)):
        if not prune or theta[i] <= 0 or q_length[i] == 0:
            whole[i] = True
            continue
        t = theta[i] / (q_length[i] * longest) if longest else np.inf
        if t > 1 + SLACK:
            continue
        n = np.searchsorted(-length, -(theta[i] / q_length[i]) * (1 - SLACK), side="right")  # length pruning
        if t < STEEP:
            if n == len(c):
                whole[i] = True
            else:
                picks[i] = np.arange(n)
            continue
        mine, keep = q[i] / q_length[i], np.arange(n)
        local = np.minimum(1.0, theta[i] / (q_length[i] * np.maximum(length[:n], 1e-300)))
        for f in np.argsort(-np.abs(mine))[:COORDINATES]:  # coordinate pruning
            least, m = local[keep], mine[f]  # the cosine may be anything from the local threshold to 1
            reach = np.sqrt(np.maximum(0, 1 - m ** 2) * np.maximum(0, 1 - least ** 2)) + 1e-7
            high = np.where(m >= least - 1e-7, 1 + 1e-7, m * least + reach)
            low = np.where(-m >= least - 1e-7, -1 - 1e-7, m * least - reach)
            keep = keep[(unit[keep, f] <= high) & (unit[keep, f] >= low)]
        picks[i] = keep
    rows = np.flatnonzero(whole)
    scores = dict(zip(rows.tolist(), _products(q[rows], c))) if len(rows) else {}
    for i in range(len(q)):
        if i in scores:
            place, s = np.arange(len(c)), scores[i]
        elif i in picks and len(picks[i]):
            place = picks[i]
            s = _products(q[i:i + 1], c[place])[0]
        else:
            continue
        other = (c_ids[place] != q_ids[i]) & (s >= theta[i])
        place, s = place[other], s[other]
        if len(place):
            best = _best(s, c_ids[place], k)
            out.append((np.full(len(best), q_ids[i]), c_ids[place][best], s[best]))
    return out


def _cells(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """``queries``: block, bucket, vec_id, v, theta; ``candidates``: block, bucket, vec_id, v."""

    def cell(key, qs: pd.DataFrame, cs: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(qs) and len(cs):
            width = max(qs["v"].map(len).max(), cs["v"].map(len).max())
            c = _matrix(cs["v"], width)
            order = np.argsort(-(c.astype(float) ** 2).sum(1), kind="stable")
            theta = qs["theta"].to_numpy(float)
            theta = np.where(np.isnan(theta), -np.inf, theta)
            found = search_cell(qs["vec_id"].to_numpy(), _matrix(qs["v"], width), theta,
                                cs["vec_id"].to_numpy()[order], c[order], k)
        cols = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), cols)))

    return queries.groupBy("block", "bucket").cogroup(candidates.groupBy("block", "bucket")).applyInPandas(cell, FOUND)


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer products of each
    query with the vectors of other ids. Both frames as ``scaled`` gives them."""
    n, m = vectors.count(), queries.count()
    n_blocks = max(1, -(-m // BLOCK_ROWS))
    norm = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    buckets = staged(vectors.withColumn("norm", norm).repartitionByRange(max(1, -(-n // BUCKET_ROWS)), F.desc("norm"), "vec_id")
                     .withColumn("bucket", F.spark_partition_id()), "buckets")
    n_buckets = (buckets.agg(F.max("bucket")).first()[0] or 0) + 1
    qs = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int"))
    # one sequence per side: each candidate meets each block of the stated queries
    grid = buckets.select("bucket", "vec_id", "v", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))
    first = _cells(qs.select("block", F.lit(0).alias("bucket"), "vec_id", "v", F.lit(None).cast("double").alias("theta")),
                   grid.where("bucket = 0"), k)
    first = staged(first, "first")
    bound = (first.groupBy("query_id").agg(F.min("score").alias("low"), F.count("*").alias("found"))
             .select(F.col("query_id").alias("vec_id"), F.when(F.col("found") >= k, F.col("low")).cast("double").alias("theta")))
    if n_buckets > 1:
        rest = qs.join(bound, "vec_id", "left").select(
            "block", F.explode(F.sequence(F.lit(1), F.lit(n_buckets - 1))).alias("bucket"), "vec_id", "v", "theta")
        found = first.unionByName(_cells(rest, grid.where("bucket > 0"), k))
    else:
        found = first
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # at most k rows a cell
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
