"""Encoding, selection and logistic scorecards on ``pyspark.ml``.

Design notes
* Every fit reads a cached, already-assembled feature vector; selection
  loops fit slices of it in shared passes, so no loop re-reads the source.
* The reference's L1 logit penalises the constant too; Spark never penalises
  the intercept, so ``logit_l1`` fits an unpenalised intercept (documented
  divergence, SURVEY 7.6). ``regParam = alpha / n`` makes Spark's
  mean-loss objective equal to sum-loss + alpha * |b|.
* The information matrix X'WX for standard errors is one distributed
  Gramian (``RowMatrix.computeGramianMatrix``: a tree aggregate of k x k
  blocks); only the k x k matrix reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import MISSING_BIN, MISSING_LEVEL
from ..functions.exprs import rnd
from ..sources.io import save_stage
from . import binning as B
from .areas import SCORE_DP, roc_areas
from .gram import _shrunk, matrix, summed
from .lookup import replace_levels
from .ordered import quantiles
from .transformers import L1Logit, ScorecardBinner, ScorecardBinnerModel

# ------------------------------------------------------------------ M1-M4


def robust_scaler(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """M1+M2 fit: per column (median, IQR) from exact quantiles; IQR 0 -> 1."""
    q = {r["feature"]: r["values"] for r in quantiles(df, cols, [0.25, 0.5, 0.75]).collect()}
    out = {}
    for c in cols:
        if c not in q:
            out[c] = (0.0, 1.0)
            continue
        q1, med, q3 = q[c]
        iqr = q3 - q1
        out[c] = (med, iqr if iqr != 0 else 1.0)
    return out


def robust_scale(df: DataFrame, params: Mapping[str, tuple[float, float]], impute: bool = True) -> DataFrame:
    """M1+M2 apply: median-impute then (x - median) / IQR."""
    return df.withColumns({c: ((F.coalesce(F.col(c).cast("double"), F.lit(m)) if impute else F.col(c)) - m) / s
                           for c, (m, s) in params.items()})


def ordinal_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M3 fit: (feature, level, code) with levels sorted ascending -> 0..k-1 (NULL -> 'missing')."""
    long = (df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(MISSING_LEVEL)).alias(c) for c in cols])
            .unpivot([], list(cols), "feature", "level").distinct())
    w = Window.partitionBy("feature").orderBy("level")  # one feature's levels: bounded by cardinality
    return long.select("feature", "level", (F.dense_rank().over(w) - 1).alias("code"))


def ordinal_encode(df: DataFrame, table: DataFrame, cols: Sequence[str], unknown: int = -9999) -> DataFrame:
    """M3 apply: code per level, unseen levels -> ``unknown`` (see ``lookup``)."""
    return replace_levels(df, table, cols, "code", unknown, null_level=MISSING_LEVEL)


def one_hot_stages(cols: Sequence[str], out: str = "features", numeric: Sequence[str] = ()) -> list:
    """M4: StringIndexer (alphabetical, keep unknown) + OneHotEncoder(dropLast) + assembler.

    With ``handleInvalid='keep'`` the indexer adds one slot for unseen
    levels as the last index; ``dropLast=True`` drops exactly that slot, so
    every training level keeps its column and an unseen level encodes to all
    zeros - scikit-learn's ``handle_unknown='ignore'``.
    """
    # one indexer for all columns: their levels are found in one pass
    idx = [StringIndexer(inputCols=list(cols), outputCols=[f"{c}__idx" for c in cols], stringOrderType="alphabetAsc",
                         handleInvalid="keep")] if cols else []
    ohe = OneHotEncoder(inputCols=[f"{c}__idx" for c in cols], outputCols=[f"{c}__ohe" for c in cols],
                        dropLast=True)
    asm = VectorAssembler(inputCols=[*numeric, *[f"{c}__ohe" for c in cols]], outputCol=out, handleInvalid="keep")
    return [*idx, ohe, asm]


def one_hot_names(model: PipelineModel, cols: Sequence[str], numeric: Sequence[str] = ()) -> list[str]:
    """Column names `feature_level` of the assembled vector (numeric first)."""
    names = list(numeric)
    labels = {}
    for s in model.stages:
        if isinstance(s, StringIndexerModel):
            outs = s.getOutputCols() if s.isSet("outputCols") else [s.getOutputCol()]  # a pipeline saved before has one a column
            labels |= {o[:-5]: lv for o, lv in zip(outs, s.labelsArray)}
    for c in cols:
        names += [f"{c}_{lv}" for lv in labels.get(c, [])]
    return names


# ------------------------------------------------------------------ M9-M14


def logistic(penalty: str = "l1", C: float | None = None, alpha: float | None = None, n_rows: int = 1,
             features: str = "features", label: str = "y", max_iter: int = 100) -> LogisticRegression:
    """Scikit-learn / statsmodels style penalties mapped to Spark's mean-loss objective.

    L1 with weight ``alpha`` (statsmodels): regParam = alpha / n. scikit-learn
    C: regParam = 1 / (C n). elasticnet mixes 0.5.
    """
    enet = {"l1": 1.0, "l2": 0.0, "elasticnet": 0.5, "none": 0.0}[penalty]
    if penalty == "none":
        reg = 0.0
    elif alpha is not None:
        reg = alpha / n_rows
    else:
        reg = 1.0 / ((C if C else 1.0) * n_rows)
    return LogisticRegression(featuresCol=features, labelCol=label, regParam=reg, elasticNetParam=enet,
                              standardization=False, fitIntercept=True, maxIter=max_iter, tol=1e-6)


def coefficient_table(spark, lr_model, names: Sequence[str], dp: int = 5) -> DataFrame:
    """(feature, coefficient) with the intercept first as 'const'."""
    rows = [("const", float(lr_model.intercept))] + [(n, float(v)) for n, v in
                                                      zip(names, lr_model.coefficients.toArray())]
    return spark.createDataFrame(rows, "feature string, coefficient double").select(
        "feature", rnd("coefficient", dp).alias("coefficient"))


def score(model: PipelineModel, df: DataFrame, prob: str = "p", label: str = "pred") -> DataFrame:
    """Probability of class 1 and the hard label (p > 0.5, T8)."""
    s = model.transform(df)
    return s.withColumn(prob, vector_to_array(F.col("probability"))[1]).withColumn(
        label, F.when(F.col(prob) > 0.5, 1).otherwise(0))


def inference_table(spark, scored: DataFrame, lr_model, names: Sequence[str], features: str = "features",
                    y: str = "y", prob: str = "p") -> DataFrame:
    """Standard error, z, p-value and 95 % CI of each non-zero coefficient,
    plus log-likelihood and McFadden pseudo-R2 as extra rows.

    X'WX (W = p(1-p)) is a distributed Gramian of sqrt(w) [1, x] rows, which
    Spark expressions build. Probabilities are kept 1e-15 away from 0 and 1 in
    the log-likelihood, so that a saturated row still counts.
    """
    from pyspark.mllib.linalg.distributed import RowMatrix
    from pyspark.mllib.util import MLUtils

    coef = np.concatenate([[lr_model.intercept], lr_model.coefficients.toArray()])
    keep = np.flatnonzero(np.abs(coef) > 1e-10)
    root = F.sqrt(F.greatest(F.col(prob) * (1 - F.col(prob)), F.lit(0.0)))
    x1 = F.concat(F.array(F.lit(1.0)), vector_to_array(features))
    rows = scored.select(x1.alias("x"), root.alias("w")).select(
        array_to_vector(F.transform("x", lambda v: v * F.col("w"))).alias("v"))
    gram = RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "v")).computeGramianMatrix().toArray()
    info = gram[np.ix_(keep, keep)]
    # one-hot levels add up to the constant, so directions of no information are cut, well above
    # what the order of summation leaves of them
    cov = np.linalg.pinv(info, rcond=1e-12, hermitian=True)
    se = np.sqrt(np.clip(np.diag(cov), 0, None))
    p = F.greatest(F.least(F.col(prob), F.lit(1 - 1e-15)), F.lit(1e-15))
    agg = scored.agg(F.sum(F.when(F.col(y) == 1, F.log(p)).otherwise(F.log(1 - p))).alias("ll"),
                     F.avg(y).alias("ybar"), F.count(F.lit(1)).alias("n")).first()
    ybar, n = agg["ybar"], agg["n"]
    ll0 = n * (ybar * math.log(ybar) + (1 - ybar) * math.log(1 - ybar)) if 0 < ybar < 1 else 0.0
    all_names = ["const", *names]
    out = []
    for j, i in enumerate(keep):
        b, s = float(coef[i]), float(se[j])
        z = b / s if s > 0 else None
        pv = math.erfc(abs(z) / math.sqrt(2)) if z is not None else None
        out.append((all_names[i], b, s, z, pv, b - 1.959963984540054 * s, b + 1.959963984540054 * s))
    out.append(("__loglik", float(agg["ll"]), None, None, None, None, None))
    out.append(("__pseudo_r2", 1 - float(agg["ll"]) / ll0 if ll0 else None, None, None, None, None, None))
    return spark.createDataFrame(out, "feature string, coefficient double, std_err double, z double, "
                                      "p_value double, ci_low double, ci_high double")


# ------------------------------------------------------------------ M15-M17


@dataclass
class Scorecard:
    """A fitted pipeline, whose first stage is the binning, and what reports read of it."""
    pipeline: PipelineModel
    names: list
    band_edges: list

    @property
    def binner(self) -> ScorecardBinnerModel:
        return self.pipeline.stages[0]

    @property
    def edges(self) -> dict:
        return self.binner.edges

    @property
    def low_card(self) -> dict:
        return self.binner.levels

    @property
    def binned(self) -> bool:
        return self.binner.getOrDefault("binned")


def build_scorecard(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], y: str = "y",
                    alpha: float = 0.8, bins: int = 5, bands: int | Sequence[float] = 5,
                    custom_edges: Mapping[str, Sequence[float]] | None = None,
                    groups: Mapping[str, Mapping[str, str]] | None = None,
                    transforms: Mapping[str, str] | None = None, binned: bool = True,
                    low_cardinality_cutoff: int = 5, penalise_constant: bool = False, method: str = "quantile",
                    max_bins: int = 20, cutoff: float = 0.001, quantiles: str = "exact") -> Scorecard:
    """M15 (first model) / M16 (refined): bins -> missing bin -> one-hot -> L1 logit -> risk bands.

    Numeric columns are binned with B2 (or B3, ``method="monotonic"``) fitted on
    ``train``, or ``custom_edges`` (B5); bins become categorical levels. Columns of at
    most ``low_cardinality_cutoff`` distinct values keep them as levels (B4); a
    level not seen in training encodes to zeros. ``penalise_constant`` fits the
    reference's own objective (``transformers.L1Logit``). Risk-band edges are quantiles
    of the training probabilities (B10) or the given cut points.
    """
    binner = ScorecardBinner(numeric=list(numeric), categorical=list(categorical), label=y, binned=binned, bins=bins, method=method,
                             maxBins=max_bins, cutoff=cutoff, lowCardinality=low_cardinality_cutoff, quantiles=quantiles,
                             customEdges={c: [float(x) for x in e] for c, e in (custom_edges or {}).items()},
                             groups={c: dict(m) for c, m in (groups or {}).items()}, transforms=dict(transforms or {})).fit(train)
    num_cols = [] if binned else list(numeric)
    # what the fit reads, and no other column
    prepared = binner.transform(train).select(*dict.fromkeys([*binner.columns, *num_cols, y])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        last = (L1Logit(label=y, alpha=float(alpha)) if penalise_constant
                else logistic("l1", alpha=alpha, n_rows=prepared.count(), label=y))
        fitted = Pipeline(stages=[*one_hot_stages(binner.columns, "features", num_cols), last]).fit(prepared)
        s = score(fitted, prepared)
        cuts = list(B.risk_band_edges(s, "p", bands).first()["edges"]) if isinstance(bands, int) else list(bands)
    finally:
        prepared.unpersist()
    return Scorecard(PipelineModel([binner, *fitted.stages]), one_hot_names(fitted, binner.columns, num_cols), cuts)


def apply_scorecard(df: DataFrame, card: Scorecard, y: str = "y") -> DataFrame:
    """Replay preparation, score, and assign risk bands (B11) on any role."""
    return B.assign_risk_band(score(card.pipeline, df), card.band_edges, "p", "risk_band")


def lr_stage(card: Scorecard):
    return card.pipeline.stages[-1]


# ------------------------------------------------------------------ M5-M8, M18


def selection_frame(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], y: str = "y", encoder: str = "woe",
                    held: bool = True):
    """M8 preprocessing: numeric median-impute + robust scale, categorical WOE (W4) or
    ordinal codes (M3), assembled into one vector column ``features`` (one slot per feature),
    cached unless what follows reads it once (``held``)."""
    from .woe import woe_encode, woe_encoder_table
    d = robust_scale(train, robust_scaler(train, numeric))
    if categorical and encoder == "ordinal":
        d = ordinal_encode(d, ordinal_table(train, categorical), categorical)
    elif categorical:
        d = woe_encode(d, woe_encoder_table(train, categorical, y), categorical)
    feats = [*numeric, *categorical]
    v = VectorAssembler(inputCols=feats, outputCol="features").transform(d).select("features", y)
    return v.persist(StorageLevel.MEMORY_AND_DISK) if held else v, feats


def _fit_subset(v: DataFrame, idx: Sequence[int], penalty="l2", C=1.0, n=1, y="y"):
    """Spark's own fit of one model; the shared fits are tested against it."""
    s = VectorSlicer(inputCol="features", outputCol="sub", indices=list(idx)).transform(v)
    return logistic(penalty, C=C, n_rows=n, features="sub", label=y).fit(s)


def _plain(v: DataFrame, y: str, fold: str | Column = "_fold") -> DataFrame:
    """(x array<double>, y, _fold) of a selection frame, as the shared passes read it."""
    return v.select(vector_to_array("features").alias("x"), F.col(y).cast("double").alias("y"),
                    (F.col(fold) if isinstance(fold, str) else fold).alias("_fold"))


def _staged(v: DataFrame, y: str, fold: str | Column, k: int) -> DataFrame:
    """``_plain`` rows of ``k`` features as a stage table of number columns: the passes read
    files, so that neither the executors' memory nor their disks hold a cache."""
    rows = _plain(v, y, fold)
    held = save_stage(rows.select(*[F.col("x")[i].alias(f"x{i}") for i in range(k)], "y", "_fold"), "selection_rows")
    return held.select(F.array(*[f"x{i}" for i in range(k)]).cast("array<double>").alias("x"), "y", "_fold")


def fit_logits(rows: DataFrame, models: Sequence[tuple], passes: int = 30, tol: float = 1e-6,
               chunk: int = 50_000, start: np.ndarray | None = None) -> np.ndarray:
    """Coefficients (models x (1 + features), the constant first, 0 where a model lacks a
    feature) of logistic models over (x, y, _fold), fitted together.

    A model is (features, fold left out, L2 weight, L1 weight); the weights stand against
    the summed loss and leave the constant free. A pass over the rows sums every live
    model's loss, gradient and Hessian: the models are the columns of one matrix, so each
    sum is a matrix product of a chunk of rows. (Proximal) Newton steps, halved where the
    objective rose, follow on the driver, on k x k matrices. ``start``: coefficients to
    begin with, as returned; what a model lacks is left out of them.
    """
    used = sorted({i for t, *_ in models for i in t})
    spot = {i: j + 1 for j, i in enumerate(used)}
    width, cols = 1 + len(used), [np.array([0, *[spot[i] for i in t]]) for t, *_ in models]
    needed = np.zeros((width, width), bool)
    for c in cols:
        needed[np.ix_(c, c)] = True
    left, right = np.nonzero(np.triu(needed))
    beta = np.zeros((len(models), width))
    if start is not None:
        for j, (t, *_) in enumerate(models):
            beta[j][cols[j]] = start[j][[0, *[i + 1 for i in t]]]
    last = [(np.inf, b.copy()) for b in beta]
    live = list(range(len(models)))

    for _ in range(passes):
        height = 1 + width + len(left)

        def sums(batch, now=beta[live].T.copy(), out=np.array([models[j][1] for j in live])):
            x, t, fold = _parts(batch, used)
            total = np.zeros((height, len(out)))
            step = max(chunk // max(len(left), len(out)), 1)
            for i in range(0, len(x), step):
                part, ty = x[i:i + step], t[i:i + step, None]
                z = part @ now
                mine = fold[i:i + step, None] != out
                e = np.exp(-np.abs(z))
                p = np.where(z >= 0, 1.0, e) / (1 + e)
                total[0] += ((np.maximum(z, 0) + np.log1p(e) - ty * z) * mine).sum(0)
                total[1:1 + width] += part.T @ ((p - ty) * mine)
                total[1 + width:] += (part[:, left] * part[:, right]).T @ (p * (1 - p) * mine)
            return total.ravel()

        total, still = summed(rows, sums, height * len(live)).reshape(height, -1), []
        for place, j in enumerate(live):
            c, (_, _, l2, l1) = cols[j], models[j]
            b, free = beta[j][c], np.r_[0.0, np.ones(len(c) - 1)]
            goal = total[0, place] + 0.5 * l2 * (free * b**2).sum() + l1 * (free * np.abs(b)).sum()
            if goal > last[j][0] + 1e-9 * abs(last[j][0]):
                beta[j] = (beta[j] + last[j][1]) / 2
                still.append(j)
                continue
            full = np.zeros((width, width))
            full[left, right] = full[right, left] = total[1 + width:, place]
            hessian, gradient = full[np.ix_(c, c)] + np.diag(l2 * free), total[1 + c, place] + l2 * free * b
            last[j] = (goal, beta[j].copy())
            moved = _shrunk(gradient, hessian, b, l1 * free) if l1 else b - np.linalg.pinv(hessian) @ gradient
            beta[j][c] = moved
            if np.abs(moved - b).max() >= tol:
                still.append(j)
        live = still
        if not live:
            break
    wide = np.zeros((len(models), max([1 + max((i + 1 for i in used), default=0), 0 if start is None else start.shape[1]])))
    wide[:, [0, *[i + 1 for i in used]]] = beta
    return wide


def _parts(batch, used):
    x = np.column_stack([np.ones(batch.num_rows), matrix(batch)[:, used]])
    return x, batch.column("y").to_numpy(zero_copy_only=False), batch.column("_fold").to_numpy(zero_copy_only=False)


def rfe(v: DataFrame, feats: Sequence[str], n_select: int, y: str = "y") -> list[str]:
    """M5: recursive elimination with L2 logistic (C = 1), dropping the smallest |coef|."""
    keep, start = list(range(len(feats))), None
    rows = _staged(v, y, F.lit(0), len(feats))
    while len(keep) > n_select:
        start = fit_logits(rows, [(keep, -1, 1.0, 0.0)], start=start)  # no row is left out
        keep.pop(int(np.argmin(np.abs(start[0, [i + 1 for i in keep]]))))
    return [feats[i] for i in keep]


def with_folds(v: DataFrame, folds: int, y: str = "y", seed: int = 144) -> DataFrame:
    """``v`` with ``_fold``, a hash of the row's content: a retried task or another
    partitioning deals rows alike, and equal rows share a fold."""
    return v.withColumn("_fold", F.pmod(F.xxhash64(vector_to_array("features"), F.col(y), F.lit(seed)),
                                        F.lit(folds)).cast("int"))


def _groups(models: Sequence[tuple], block: int) -> list[Sequence[tuple]]:
    """The models in groups whose sums stay below ``block`` numbers a partition."""
    k = 1 + len({i for t, *_ in models for i in t})
    per = max(block // (1 + k + k * (k + 1) // 2), 1)
    return [models[i:i + per] for i in range(0, len(models), per)]


def cv_accuracies(v: DataFrame, trials: Sequence[Sequence[int]], sizes: Mapping[int, int], y: str = "y",
                  C: float = 1.0, passes: int = 30, tol: float = 1e-6, block: int = 4_000_000) -> list[float]:
    """Mean accuracy over the folds of ``with_folds`` (``sizes``: rows per fold) of an L2
    logistic on each trial's features. Trials and folds are fitted together
    (``fit_logits``), in groups whose sums stay below ``block`` numbers a partition."""
    return _accuracies(_plain(v, y), trials, sizes, C, passes, tol, block)[0]


def _accuracies(rows, trials, sizes, C=1.0, passes=30, tol=1e-6, block=4_000_000, start=None) -> tuple[list[float], np.ndarray]:
    """The accuracies and the coefficients (trials x folds x ...); ``start`` has one row a fold."""
    models, hits, fitted = [(list(t), k, 1 / C, 0.0) for t in trials for k in sorted(sizes)], [], []
    wide = 2 + max((i for t in trials for i in t), default=-1)
    for group in _groups(models, block):
        first = None if start is None else np.array([start[sorted(sizes).index(k)] for _, k, *_ in group])
        beta, used = fit_logits(rows, group, passes, tol, start=first), sorted({i for t, *_ in group for i in t})
        fitted.append(np.pad(beta, ((0, 0), (0, max(wide - beta.shape[1], 0)))))
        at, out = beta[:, [0, *[i + 1 for i in used]]].T.copy(), np.array([k for _, k, *_ in group])

        def right(batch, at=at, out=out, used=used):
            x, t, fold = _parts(batch, used)
            return (((x @ at > 0) == (t[:, None] == 1)) & (fold[:, None] == out)).sum(0).astype(float)

        hits.append(summed(rows, right, len(group)))
    share = np.concatenate([np.zeros(0), *hits]) / np.array([sizes[k] for _, k, *_ in models])
    return share.reshape(len(trials), len(sizes)).mean(1).tolist(), np.concatenate(fitted).reshape(len(trials), len(sizes), -1)


def sequential_select(v: DataFrame, feats: Sequence[str], n_select: int, direction: str = "forward",
                      y: str = "y", folds: int = 5) -> list[str]:
    """M6: greedy forward / backward selection by k-fold accuracy of an L2 logistic."""
    rows = _staged(with_folds(v, folds, y), y, "_fold", len(feats))
    sizes = {r["_fold"]: r["n"] for r in rows.groupBy("_fold").agg(F.count("*").alias("n")).collect()}
    cur, start = [] if direction == "forward" else list(range(len(feats))), None
    while len(cur) != n_select:
        cands = [i for i in range(len(feats)) if i not in cur] if direction == "forward" else list(cur)
        trials = [sorted(cur + [c]) if direction == "forward" else [i for i in cur if i != c] for c in cands]
        # the next round begins at the coefficients of the round's choice
        found, fitted = _accuracies(rows, trials, sizes, start=start)
        best = max(zip(found, cands), key=lambda t: t[0])[1]  # the first of equals
        start = np.pad(fitted[cands.index(best)], ((0, 0), (0, 1 + len(feats) - fitted.shape[2])))
        cur = sorted(cur + [best]) if direction == "forward" else [i for i in cur if i != best]
    return [feats[i] for i in cur]


def l1_select(v: DataFrame, feats: Sequence[str], n_select: int | None, y: str = "y", C: float = 0.1):
    """M7: L1 logistic (C = 0.1); keep |coef| > 1e-5, the n largest."""
    n = v.count()
    m = logistic("l1", C=C, n_rows=n, label=y).fit(v)
    coefs = m.coefficients.toArray()
    order = [i for i in np.argsort(-np.abs(coefs)) if abs(coefs[i]) > 1e-5]
    if n_select:
        order = order[:n_select]
    return [(feats[i], float(coefs[i])) for i in order]


def random_search(v: DataFrame, draws: int = 20, folds: int = 5, y: str = "y", seed: int = 144,
                  penalties: Sequence[str] = ("l1", "l2"), log10_c: tuple[float, float] = (-4.0, 4.0),
                  block: int = 4_000_000) -> list[tuple]:
    """``draws`` random (penalty, C) with C log-uniform, each scored by mean ROC
    AUC over ``folds`` folds: [(penalty, C, auc)], best first, draw order on ties.

    All draws and folds are fitted together (``fit_logits``). The areas are exact, over
    the scores of the rows left out (``areas``); without positives an area is
    0, without negatives 1, as Spark's evaluator has it.
    """
    rng = np.random.default_rng(seed)
    grid = [(str(rng.choice(list(penalties))), float(10 ** rng.uniform(*log10_c))) for _ in range(draws)]
    mixed = {"l1": (0.0, 1.0), "l2": (1.0, 0.0), "elasticnet": (0.5, 0.5), "none": (0.0, 0.0)}
    first = v.first()
    if first is None:
        return [(*g, float("nan")) for g in grid]
    used = list(range(len(first["features"])))
    rows = _staged(with_folds(v, folds, y, seed), y, "_fold", len(used))
    models = [(used, k, *[w / c for w in mixed[penalty]]) for penalty, c in grid for k in range(folds)]
    beta = np.concatenate([fit_logits(rows, g, passes=100) for g in _groups(models, block)])
    at = beta.reshape(draws, folds, -1)

    def scores(b):
        x, t, fold = _parts(b, used)
        z = np.empty((len(x), draws))
        for k in range(folds):
            z[fold == k] = np.einsum("ij,gj->ig", x[fold == k], at[:, k])
        return np.round(z, SCORE_DP) + 0.0, t == 1, fold  # equal rows score alike wherever they stand

    areas = roc_areas(rows, scores, folds)
    auc = {c: u / (float(p) * n) if p and n else 0.0 if not p else 1.0 for c, (u, p, n) in areas.items()}
    out = [(*g, float(np.mean([auc[i * folds + k] for k in range(folds) if i * folds + k in auc]))) for i, g in enumerate(grid)]
    return sorted(out, key=lambda r: -r[2])


def default_n_features(k: int) -> int:
    """M8 default size: max(int(log2(#features)), 5)."""
    return max(int(math.log2(k)) if k > 0 else 0, 5)


def build_woe_model(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], y: str = "y",
                    bins: int = 5, C: float = 0.1):
    """B2 bins, WOE-encode bins and levels (W4), L1 logistic with C = 0.1."""
    from .woe import woe_encode, woe_encoder_table
    edges = B.edges_dict(B.forced_edges(train, numeric, bins))
    binned = B.apply_bins(train, edges, missing_bin=MISSING_BIN).withColumns(
        {c: F.col(c).cast("string") for c in edges})
    cols = [*edges, *categorical]
    binned = binned.select(*dict.fromkeys([*cols, y]))
    table = woe_encoder_table(binned, cols, y)
    enc = woe_encode(binned, table, cols)
    v = VectorAssembler(inputCols=cols, outputCol="features").transform(enc)
    m = logistic("l1", C=C, n_rows=train.count(), label=y).fit(v)
    return m, cols, table, edges
