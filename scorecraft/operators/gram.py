"""Sums of products over all rows, in blocks: moments, correlations and Newton passes.

Each Arrow batch becomes a matrix, each partition adds its matrices up, and the
partitions' totals (a vector of k x k numbers) are added by position before they
leave the executors. Plans do not grow with the number of columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    """The rows of an ``array<double>`` column of equal lengths; NULL items are NaN."""
    lists = batch.column(column)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else np.zeros((0, 0))


def summed(rows: DataFrame, fn: Callable[[pa.RecordBatch], np.ndarray], width: int) -> np.ndarray:
    """Sum over all batches of ``fn(batch)``, a vector of ``width`` numbers."""

    def run(batches):
        total = np.zeros(width)
        for b in batches:
            if b.num_rows:
                total += fn(b)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["v"])

    parts = rows.mapInArrow(run, "v array<double>").select(F.posexplode("v").alias("i", "v"))
    out = np.zeros(width)
    for r in parts.groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out


def _numbers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols]).alias("x"))


def masked_moments(df: DataFrame, cols: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(n, sum x_i, sum x_i^2, sum x_i x_j, centre), k x k each, over the rows in which
    both i and j have a value. Values are taken off a centre near their means
    (a first, cheap pass), so that nothing cancels."""
    k = len(cols)
    row = df.agg(*[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    centre = np.array([row[f"m{i}"] if row[f"m{i}"] is not None else 0.0 for i in range(k)])

    def products(batch):
        x = matrix(batch) - centre
        there = (~np.isnan(x)).astype(float)
        x = np.where(there > 0, x, 0.0)
        return np.concatenate([(there.T @ there).ravel(), (x.T @ there).ravel(), ((x * x).T @ there).ravel(), (x.T @ x).ravel()])

    got = summed(_numbers(df, cols), products, 4 * k * k).reshape(4, k, k)
    return got[0], got[1], got[2], got[3], centre


def pairwise_correlation(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """Pearson correlation of every pair over the rows that have both; NaN where undefined."""
    n, sx, sxx, sxy, _ = masked_moments(df, cols)
    with np.errstate(divide="ignore", invalid="ignore"):
        cov = sxy - sx * sx.T / n
        var = sxx - sx * sx / n
        out = cov / np.sqrt(var * var.T)
    small = 1e-12 * np.maximum(sxx, 1e-300)
    out[(var <= small) | (var.T <= small.T)] = np.nan
    return np.clip(out, -1, 1)


def complete_moments(df: DataFrame, cols: Sequence[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """n, means and the sample covariance matrix of the rows that have all columns."""
    d = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols]).dropna()
    n, sx, _, sxy, centre = masked_moments(d, cols)
    rows = n[0, 0]
    return int(rows), centre + sx[:, 0] / max(rows, 1), (sxy - np.outer(sx[:, 0], sx[:, 0]) / max(rows, 1)) / max(rows - 1, 1)


def class_moments(df: DataFrame, features: str, label: str, k: int) -> dict[float, tuple[int, np.ndarray, np.ndarray]]:
    """Per class of ``label``: n, means and sample covariance of an ``array<double>`` column of ``k`` items."""
    classes = sorted(r[label] for r in df.select(label).distinct().collect())
    centre = np.array([r["m"] for r in df.select(F.posexplode(features).alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m"))
                      .orderBy("i").collect()])

    def products(batch):
        x, y = matrix(batch) - centre, batch.column("y").to_numpy(zero_copy_only=False)
        return np.concatenate([np.concatenate([[len(m)], m.sum(0), (m.T @ m).ravel()]) for m in (x[y == c] for c in classes)])

    got = summed(df.select(F.col(features).alias("x"), F.col(label).alias("y")), products, len(classes) * (1 + k + k * k))
    out = {}
    for c, part in zip(classes, got.reshape(len(classes), -1)):
        n, s, xx = part[0], part[1:1 + k], part[1 + k:].reshape(k, k)
        out[c] = (int(n), centre + s / n, (xx - np.outer(s, s) / n) / max(n - 1, 1))
    return out


# ------------------------------------------------------------------ penalised logit


def logit_sums(rows: DataFrame, beta: np.ndarray, steps: Sequence[np.ndarray] = ()) -> tuple[float, np.ndarray, np.ndarray, list[float]]:
    """One pass over (x array<double>, y): the loss, gradient and information at ``beta``
    (constant first), and the losses at other ``steps``."""
    k = len(beta)

    def sums(batch):
        x = np.column_stack([np.ones(batch.num_rows), matrix(batch)])
        y = batch.column("y").to_numpy(zero_copy_only=False)
        z = x @ beta
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        others = [(np.logaddexp(0, x @ b) - y * (x @ b)).sum() for b in steps]
        return np.concatenate([[(np.logaddexp(0, z) - y * z).sum()], x.T @ (p - y), ((x * (p * (1 - p))[:, None]).T @ x).ravel(), others])

    got = summed(rows, sums, 1 + k + k * k + len(steps))
    return got[0], got[1:1 + k], got[1 + k:1 + k + k * k].reshape(k, k), got[1 + k + k * k:].tolist()


def _shrunk(gradient: np.ndarray, hessian: np.ndarray, beta: np.ndarray, weight: np.ndarray, sweeps: int = 1000) -> np.ndarray:
    """Minimum of the quadratic model at ``beta`` plus the weighted L1 norm, by coordinate descent."""
    b, scale = beta.copy(), np.maximum(np.diag(hessian), 1e-12)
    slope = gradient.copy()  # of the model at b
    for _ in range(sweeps):
        moved = 0.0
        for j in range(len(b)):
            free = b[j] - slope[j] / scale[j]
            new = np.sign(free) * max(abs(free) - weight[j] / scale[j], 0.0)
            if new != b[j]:
                slope += hessian[:, j] * (new - b[j])
                moved = max(moved, abs(new - b[j]) * np.sqrt(scale[j]))
                b[j] = new
        if moved < 1e-10:
            break
    return b


def stationarity(gradient: np.ndarray, beta: np.ndarray, weight: np.ndarray) -> float:
    """How far the optimality conditions are missed: |gradient| <= weight where a coefficient is
    zero, gradient = -weight x sign elsewhere."""
    zero = np.maximum(np.abs(gradient) - weight, 0.0)
    return float(np.where(beta == 0, zero, np.abs(gradient + weight * np.sign(beta))).max(initial=0.0))


def l1_logit(rows: DataFrame, k: int, alpha: float, penalise_constant: bool = True, passes: int = 100, tol: float = 1e-6) -> tuple[np.ndarray, float]:
    """(coefficients with the constant first, how far stationarity is missed) of
    sum-loss + alpha x L1 norm over (x array<double> of ``k`` items, y).

    Proximal Newton: a pass sums loss, gradient and information, the penalised
    quadratic model is solved on the driver (k x k), and the step is halved until
    the objective falls; a pass tries eight halvings together. Ends when the
    conditions hold to ``tol`` times the rows' scale.
    """
    weight = np.full(k + 1, float(alpha))
    if not penalise_constant:
        weight[0] = 0.0
    beta = np.zeros(k + 1)
    loss, gradient, information, _ = logit_sums(rows, beta)
    scale = max(1.0, np.abs(gradient).max(initial=0.0), alpha)
    for _ in range(passes):
        if stationarity(gradient, beta, weight) <= tol * scale:
            break
        goal = _shrunk(gradient, information, beta, weight)
        if np.array_equal(goal, beta):
            break
        now = loss + weight @ np.abs(beta)
        tries = [beta + (goal - beta) / 2**i for i in range(8)]
        full = logit_sums(rows, tries[0], tries[1:])
        values = [v + weight @ np.abs(b) for v, b in zip([full[0], *full[3]], tries)]
        best = int(np.argmin(values))
        if values[best] > now + 1e-12 * abs(now):
            break
        beta = tries[best]
        loss, gradient, information, _ = full if best == 0 else logit_sums(rows, beta)
    return beta, stationarity(gradient, beta, weight)
