"""Composed flows: the reference's pipeline stages as functions
of DataFrames, with stage tables written to the shared checkpoint folder.

One immutable :class:`~scorecraft.config.ScorecardConfig` is passed to every
stage (the reference's class attributes silently reset between stages).
Each stage reads the previous stage's table, so a failed stage restarts from
its input table rather than from the raw sources. ``run_stage`` runs one stage as a
job of its own: its state is written below a path and read by the next, in another
application if need be.
"""

from __future__ import annotations

import json
import warnings
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ScorecardConfig
from ..operators import association as C
from ..operators import binning as B
from ..operators import performance as E
from ..operators import prep as P
from ..operators import profile as A
from ..operators import stability as D
from ..operators import woe as W
from ..operators.distcheck import distribution_check
from ..operators.model import apply_scorecard, build_scorecard
from ..sources.io import (load_model, load_roles, new_run, read_dataset, save_model, save_stage, write_cleansed, write_metrics,
                          write_report_table, write_scored)


@dataclass
class FlowState:
    """What the reference keeps on its pipeline object: the data and the feature list."""
    data: DataFrame
    numeric: list
    categorical: list
    reports: dict = field(default_factory=dict)
    card: object = None
    run: str = field(default_factory=new_run)  # the folder of this run's stage tables
    scored: DataFrame | None = None


def load_inputs(spark: SparkSession, train: str, test: str | None = None, pdv: str | None = None, oot: str | None = None, **kw) -> DataFrame:
    """The role files as one frame. A test or PDV file must have the training
    file's columns; an OOT file that lacks or adds some is accepted with a warning."""
    first = read_dataset(spark, train, "Train", **kw)
    for path, role in ((test, "Test"), (pdv, "PDV"), (oot, "OOT")):
        if path:
            differ = P.check_same_columns(first, read_dataset(spark, path, role, **kw), strict=role != "OOT").collect()
            if differ:
                warnings.warn(f"columns of Train and {role} differ: {[(r['column'], r['side']) for r in differ]}", stacklevel=2)
    return load_roles(spark, train, test, pdv, oot, **kw).select(*first.columns)


def prepare_data(df: DataFrame, cfg: ScorecardConfig, persist: bool = True) -> FlowState:
    """exclusions, all-null columns, de-duplication, target, split where no test rows are
    given, profiles, missing / cardinality drops, imputation, distribution check.

    The labelled rows are written once, before the passes that profile them.
    """
    run = new_run()
    split_on = cfg.split_key if cfg.split_key in df.columns else None
    d = df.withColumn("_split", F.col(split_on)) if split_on else df
    d = P.exclude_columns(d, cfg.exclude)
    d = P.drop_duplicate_rows(d)
    d = P.derive_target(d, cfg.target, cfg.bad_values)
    d = P.encode_target(d, "yTarget", "y")
    if cfg.sample_fraction:
        d = P.sample_rows(d, cfg.sample_fraction, cfg.seed)
    if persist:
        d = save_stage(d, "labelled", run=run)
    roles = {r["source"] for r in d.select("source").distinct().collect()}
    if "Test" not in roles:  # only the training rows are split
        dealt = P.split_by_key(d, "_split" if split_on else "", cfg.test_fraction, cfg.seed, "_role")
        d = dealt.withColumn("source", F.when(F.col("source") == "Train", F.col("_role")).otherwise(F.col("source"))).drop("_role")
    d = d.drop("_split")
    empty = set(P.all_null_columns(d.where(F.col("source") == "Train"))) - {cfg.target, "yTarget", "y", "source"}
    d = d.drop(*empty)
    num, cat = P.split_by_dtype(d, exclude=[cfg.target, "yTarget", "y", "source"])
    train = d.where(F.col("source") == "Train")
    reports = {"target": P.target_summary(d, "yTarget", keys=["source"])}
    miss = A.missing_profile(train, num + cat)
    dropped = set(P.high_missing(miss, cfg.missing_threshold, cfg.missing_denominator))
    dropped |= set(P.high_cardinality(train, [c for c in cat if c not in dropped], cfg.max_cardinality))
    num = [c for c in num if c not in dropped]
    cat = [c for c in cat if c not in dropped]
    d = d.drop(*dropped)
    if cfg.distribution_check:
        for role in sorted((roles | {"Test"}) - {"Train"}):
            reports[f"distribution_{role}"] = distribution_check(d.where(F.col("source") == "Train"), d.where(F.col("source") == role), num, cat,
                                                                 cfg.distribution_check, cfg.seed, svd_k=len(num) + len(cat))
    if cfg.impute_numeric == "drop":
        d = P.impute_numeric(d, {c: 0.0 for c in num}, "drop")
    else:
        vals = P.impute_values(train, num, cfg.impute_numeric, cfg.numeric_fill)
        d = P.impute_numeric(d, vals)
    d = P.impute_categorical(d, cat, cfg.categorical_fill)
    if persist:
        d = save_stage(d, "prepared", run=run)
    return FlowState(d, num, cat, reports | {"missing": miss, "describe": A.describe_numeric(train, num)}, run=run)


def reduce_variables(st: FlowState, cfg: ScorecardConfig, enforce: bool = False) -> FlowState:
    """IV filter, correlation screen, chi-square / Cramér's V filter, VIF."""
    train = st.data.where(F.col("source") == "Train")
    iv, _ = W.iv_report(train, st.numeric, st.categorical, "y", cfg.iv_bins, method=cfg.quantile_method, accuracy=cfg.quantile_accuracy)
    keep = {r["feature"] for r in W.iv_filter(iv, cfg.iv_threshold).where("keep").collect()}
    num = [c for c in st.numeric if c in keep]
    cat = [c for c in st.categorical if c in keep]
    corr = C.correlation_matrix(train, num) if len(num) > 1 else None
    elim = set()
    if corr is not None:
        pairs = C.correlated_pairs(corr, iv, cfg.correlation_threshold)
        if enforce:
            elim |= {r["feature"] for r in pairs.collect()}
    if cat:
        cv = C.cramers_v(C.chi_square(A.contingency(train, {}, cat, "y")))
        card = A.distinct_profile(train, cat)
        filt = C.cramersv_filter(cv, card, cfg.cramersv_threshold, cfg.max_cardinality)
        elim |= {r["feature"] for r in filt.where("eliminate").collect()}
        st.reports["chi_square"] = cv
    num = [c for c in num if c not in elim]
    cat = [c for c in cat if c not in elim]
    if len(num) > 1:
        v = C.vif_filter(C.vif(train, num), cfg.vif_threshold)
        st.reports["vif"] = v
    st.reports.update({"iv": iv, "correlation": corr})
    return FlowState(st.data, num, cat, st.reports, st.card, st.run)


def feature_selection(st: FlowState, cfg: ScorecardConfig) -> FlowState:
    """model-based selection (M8) on the reduced list."""
    from ..operators import model as M
    train = st.data.where(F.col("source") == "Train")
    v, feats = M.selection_frame(train, st.numeric, st.categorical, encoder=cfg.selection_encoder,
                                 held=cfg.selection_method not in ("RFE", "forward", "backward"))
    try:
        n = cfg.max_features or M.default_n_features(len(feats))
        if cfg.selection_method == "RFE":
            chosen = M.rfe(v, feats, min(n, len(feats)))
        elif cfg.selection_method in ("forward", "backward"):
            chosen = M.sequential_select(v, feats, min(n, len(feats)), cfg.selection_method)
        else:
            chosen = [f for f, _ in M.l1_select(v, feats, n)]
    finally:
        v.unpersist()
    return FlowState(st.data, [c for c in st.numeric if c in chosen], [c for c in st.categorical if c in chosen],
                     st.reports, st.card, st.run)


def model_building(st: FlowState, cfg: ScorecardConfig, refine: bool = False) -> FlowState:
    """First (or refined) scorecard, then the reports of F6."""
    train = st.data.where(F.col("source") == "Train")
    kw = dict(bands=cfg.risk_bands)
    if refine:
        kw = dict(custom_edges=cfg.custom_edges or None, groups=cfg.category_groups or None,
                  transforms=cfg.transforms or None, bands=list(cfg.band_cuts) if cfg.band_cuts else cfg.risk_bands)
    card = build_scorecard(train, st.numeric, st.categorical, "y", cfg.l1_alpha, cfg.model_bins, binned=cfg.binned,
                           low_cardinality_cutoff=cfg.low_cardinality_cutoff, penalise_constant=cfg.penalise_constant,
                           method=cfg.binning_method, max_bins=cfg.max_bins, cutoff=cfg.monotonic_cutoff, quantiles=cfg.quantile_method, **kw)
    st = FlowState(st.data, st.numeric, st.categorical, dict(st.reports), card, st.run)
    return generate_reports(st, cfg)


def generate_reports(st: FlowState, cfg: ScorecardConfig) -> FlowState:
    """score every role once, then the report tables from that one scored frame."""
    s = apply_scorecard(st.data, st.card)
    s = save_stage(s.drop("features", "rawPrediction", "probability", *[c for c in s.columns if c.endswith("__idx")
                                                                          or c.endswith("__ohe")]),
                   f"scored-{new_run()}", run=st.run)
    levels = [*st.categorical, *st.card.low_card]
    bin_cols = list(st.card.edges) if st.card.binned else []
    ct = A.contingency(s, {c: F.col(c).cast("int") for c in bin_cols}, levels, "pred", ["source"])
    perf = W.bin_performance(ct, ["source"])
    detail = D.csi_detail(perf)
    chi = C.chi_square(A.contingency(s, {}, st.categorical, "pred", ["source"]), ["source"])
    st.reports.update({
        "accuracy": E.accuracy_summary(s, "p", "y", "pred"),
        "bin_performance": perf,
        "iv_by_source": W.iv_by_source(perf),
        "cramersv_by_source": C.cramersv_by_source(chi),
        "csi_detail": detail,
        "csi_summary": D.csi_summary(detail),
        "band_psi": D.band_table(s, "risk_band", "y"),
        "role_comparison": E.role_comparison(s, "y", "pred"),
        "bin_info": B.bin_info(ct.where(F.col("source") == "Train"),
                               s.sparkSession.createDataFrame([(f, e) for f, e in st.card.edges.items()]
                                                              or [("", [])], "feature string, edges array<double>")),
    })
    st.reports["band_psi_total"] = D.band_psi_total(st.reports["band_psi"])
    drift = [c for c in st.reports["csi_summary"].columns if c.startswith("PSI_")]
    st.reports["csi_flags"] = st.reports["csi_summary"].select(
        "feature", *[(F.col(c) > cfg.csi_threshold).alias(c.replace("PSI_", "drifted_")) for c in drift])
    st.scored = s
    return st


def execute(df: DataFrame, cfg: ScorecardConfig, select: bool = True, refine: bool = False) -> FlowState:
    """all stages in one session."""
    st = prepare_data(df, cfg)
    st = reduce_variables(st, cfg)
    if select:
        st = feature_selection(st, cfg)
    return model_building(st, cfg, refine)


# ------------------------------------------------------------------ hand-over between applications

STAGES = {
    "prepare": prepare_data,
    "reduce": reduce_variables,
    "select": feature_selection,
    "build": model_building,
    "refine": lambda st, cfg: model_building(st, cfg, refine=True),
}


def is_committed(spark: SparkSession, path: str) -> bool:
    """Whether a stage's state is whole: its marker is written last."""
    try:
        return spark.read.text(f"{path}/state").count() > 0
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return False
        raise


def save_state(st: FlowState, path: str) -> str:
    """Everything that the next stage needs below ``path``: rows (S3), scored rows (S4), report tables
    (S5), accuracy figures (S6), the scorecard (S8) and, last, the marker with the lists. A path
    holds one state; what a failed stage left there without a marker is written over."""
    spark = st.data.sparkSession
    if is_committed(spark, path):
        raise ValueError(f"{path} holds a state already")
    write_cleansed(st.data, f"{path}/data")
    tables = {n: df for n, df in st.reports.items() if df is not None}
    for name, df in tables.items():
        write_report_table(df, f"{path}/reports", name)
    if st.card is not None:
        save_model(st.card, f"{path}/card")
    if st.scored is not None:
        write_scored(st.scored, f"{path}/scored")
    if "accuracy" in tables:
        write_metrics(spark, {f"{r['source']}_{m}": r[m] for r in spark.read.parquet(f"{path}/reports/accuracy").collect() for m in ("auc", "ks")},
                      f"{path}/metrics")
    state = {"numeric": st.numeric, "categorical": st.categorical, "reports": sorted(tables), "empty": sorted(set(st.reports) - set(tables)),
             "card": st.card is not None, "scored": st.scored is not None, "run": st.run, "columns": st.data.columns}
    spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/state")
    return path


def load_state(spark: SparkSession, path: str) -> FlowState:
    """The state that :func:`save_state` wrote, in any application that reaches ``path``."""
    if not is_committed(spark, path):
        raise ValueError(f"{path} holds no whole state")
    state = json.loads(spark.read.text(f"{path}/state").first()["value"])
    reports = {n: spark.read.parquet(f"{path}/reports/{n}") for n in state["reports"]} | {n: None for n in state["empty"]}
    return FlowState(spark.read.parquet(f"{path}/data").select(*state["columns"]), state["numeric"], state["categorical"], reports,
                     load_model(spark, f"{path}/card") if state["card"] else None, state["run"],
                     spark.read.parquet(f"{path}/scored") if state["scored"] else None)


def run_stage(spark: SparkSession, name: str, base: str, cfg: ScorecardConfig, after: str | None = None, df: DataFrame | None = None) -> str:
    """One stage of ``STAGES`` as a job of its own: reads the state of ``after`` (or ``df`` for
    ``prepare``), writes its own state to ``base/name`` and returns that path. A stage
    that is committed already is left as it is, so a restarted chain goes on where it ended."""
    path = f"{base.rstrip('/')}/{name}"
    if is_committed(spark, path):
        return path
    before = df if name == "prepare" else load_state(spark, f"{base.rstrip('/')}/{after}")
    return save_state(STAGES[name](before, cfg), path)
