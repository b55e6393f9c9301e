"""Model performance.

Confusion counts are conditional sums in one aggregate per source. KS and
its curve use :func:`scorecraft.operators.ordered.running_totals`, which
collapses equal scores (tie-aware, T18) and never sorts all rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import cut, rnd, safe_div
from .binning import score_decile_edges
from .ordered import running_totals


def hard_label(p, threshold: float = 0.5):
    """Python round() half-to-even -> 1 iff p > 0.5."""
    return F.when(F.col(p) > threshold, 1).otherwise(0) if isinstance(p, str) else \
        F.when(p > threshold, 1).otherwise(0)


def confusion_matrix(df: DataFrame, y: str = "y", pred: str = "pred", keys: Sequence[str] = ()) -> DataFrame:
    """Tn, fp, fn, tp (actual x predicted)."""
    a, p = F.col(y).cast("int"), F.col(pred).cast("int")

    def cnt(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    return df.groupBy(*keys).agg(cnt((a == 0) & (p == 0)).alias("tn"), cnt((a == 0) & (p == 1)).alias("fp"),
                                 cnt((a == 1) & (p == 0)).alias("fn"), cnt((a == 1) & (p == 1)).alias("tp"))


def auc_hard(cm: DataFrame) -> DataFrame:
    """ROC AUC of hard labels = (TPR + TNR) / 2."""
    tpr = safe_div("tp", F.col("tp") + F.col("fn"))
    tnr = safe_div("tn", F.col("tn") + F.col("fp"))
    return cm.withColumn("auc", (F.coalesce(tpr, F.lit(0.0)) + F.coalesce(tnr, F.lit(0.0))) / 2)


def classification_report(cm: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, f1, support per class, accuracy, macro and weighted averages.

    Undefined ratios are 0 (scikit-learn's zero_division default with a warning).
    """
    def z(x):
        return F.coalesce(x, F.lit(0.0))
    rows = []
    for cls, tp, fp, fn in (("0", "tn", "fn", "fp"), ("1", "tp", "fp", "fn")):
        prec = z(safe_div(tp, F.col(tp) + F.col(fp)))
        rec = z(safe_div(tp, F.col(tp) + F.col(fn)))
        rows.append(F.struct(F.lit(cls).alias("label"), prec.alias("precision"), rec.alias("recall"),
                             z(safe_div(2 * prec * rec, prec + rec)).alias("f1"),
                             (F.col(tp) + F.col(fn)).cast("double").alias("support")))
    per = cm.select(*keys, F.inline(F.array(*rows)))
    tot = (cm.select(*keys, (F.col("tn") + F.col("tp")).alias("_ok"),
                     (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("_n")))
    acc = tot.select(*keys, F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), z(safe_div("_ok", "_n")).alias("f1"),
                     F.col("_n").cast("double").alias("support"))
    g = per.groupBy(*keys)
    macro = g.agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                  F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.sum("support").alias("support"))
    sw = F.sum("support")
    weighted = g.agg(F.lit("weighted avg").alias("label"),
                     z(safe_div(F.sum(F.col("precision") * F.col("support")), sw)).alias("precision"),
                     z(safe_div(F.sum(F.col("recall") * F.col("support")), sw)).alias("recall"),
                     z(safe_div(F.sum(F.col("f1") * F.col("support")), sw)).alias("f1"), sw.alias("support"))
    out = per.unionByName(acc).unionByName(macro).unionByName(weighted)
    return out.select(*keys, "label", *[rnd(c, 6).alias(c) for c in ("precision", "recall", "f1")],
                      F.col("support").cast("long").alias("support"))


def ks_curve(df: DataFrame, score: str = "score", y: str = "y", keys: Sequence[str] = (),
             parts: int | None = None) -> DataFrame:
    """E5: per distinct score (ascending) the cumulative population / target /
    non-target counts, their shares and |cum target share - cum non-target share|."""
    base = df.select(*keys, F.col(score).alias("score"), F.col(y).cast("long").alias("_t"),
                     F.lit(1).cast("long").alias("_n"))
    rt = running_totals(base, keys, "score", ["_n", "_t"], parts)
    cum_non = F.col("cum__n") - F.col("cum__t")
    tot_non = F.col("tot__n") - F.col("tot__t")
    return rt.select(*keys, "score", F.col("cum__n").alias("cum_population"),
                     F.col("cum__t").alias("cum_target"), cum_non.alias("cum_non_target"),
                     (F.col("cum__n") / F.col("tot__n")).alias("cum_population_pct"),
                     safe_div("cum__t", "tot__t").alias("cum_target_pct"),
                     safe_div(cum_non, tot_non).alias("cum_non_target_pct")) \
        .withColumn("ks", F.abs(F.col("cum_target_pct") - F.col("cum_non_target_pct")))


def ks(df: DataFrame, score: str = "score", y: str = "y", keys: Sequence[str] = (),
       parts: int | None = None) -> DataFrame:
    """Max over the (tie-collapsed) curve of E5."""
    return ks_curve(df, score, y, keys, parts).groupBy(*keys).agg(F.max("ks").alias("ks"))


def ks_table(df: DataFrame, score: str = "score", y: str = "y", bad: float = 1.0, bins: int = 10,
             edges: Sequence[float] | None = None) -> DataFrame:
    """Decile table of a score, highest decile first (2 dp columns).

    Edges: B9 (score quantiles at i/bins, 1 dp, min -> 0, max -> 1) unless
    given; cut right-closed with the lowest included. TARGET = (y == bad).
    """
    e = list(edges) if edges is not None else score_decile_edges(df, score, bins)
    t = df.select(cut(F.col(score), e, True).alias("bin"),
                  (F.col(y) == bad).cast("long").alias("TARGET")).where(F.col("bin").isNotNull())
    g = t.groupBy("bin").agg(F.sum("TARGET").alias("TARGET"), F.count(F.lit(1)).alias("TOTAL"))
    g = g.withColumn("NONTARGET", F.col("TOTAL") - F.col("TARGET"))
    w = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wall = Window.partitionBy()  # at most `bins` rows: a single-partition window is fine
    g = g.select("*", F.sum("TARGET").over(wall).alias("_tt"), F.sum("NONTARGET").over(wall).alias("_tn"),
                 F.sum("TOTAL").over(wall).alias("_n"),
                 F.sum("TARGET").over(w).alias("Cumulative_Target"),
                 F.sum("NONTARGET").over(w).alias("Cumulative_NonTarget"),
                 F.sum("TOTAL").over(w).alias("Cumulative_Total"))
    pop = rnd(F.col("TOTAL") / F.col("_n") * 100, 2)
    gain = rnd(safe_div("Cumulative_Target", "_tt") * 100, 2)
    nont = rnd(safe_div("Cumulative_NonTarget", "_tn") * 100, 2)
    lo = F.element_at(F.array(*[F.lit(float(x)) for x in e]), F.col("bin") + 1)
    hi = F.element_at(F.array(*[F.lit(float(x)) for x in e]), F.col("bin") + 2)
    return g.select(F.col("bin").alias("DECILE"), lo.alias("score_lo"), hi.alias("score_hi"),
                    "TARGET", "NONTARGET", "TOTAL", pop.alias("Population_pct"),
                    rnd(safe_div("TARGET", "_tt") * 100, 2).alias("BAD_CAPTURED"),
                    "Cumulative_Target", "Cumulative_NonTarget", "Cumulative_Total",
                    gain.alias("Cumulative_Target_pct"), nont.alias("Cumulative_NonTarget_pct"),
                    rnd(gain - nont, 2).alias("KS"), rnd(safe_div(gain, pop), 6).alias("CumulativeLift"))


def accuracy_summary(df: DataFrame, score: str = "score", y: str = "y", pred: str = "pred",
                     sources: Sequence[str] = ("Test", "OOT", "PDV")) -> DataFrame:
    """Hard-label AUC and KS per source, 5 dp (long form: source, auc, ks)."""
    base = df.where(F.col("source").isin(*sources)).select(
        "source", F.col(score).alias("score"), F.lit(1).cast("long").alias("_n"), F.col(y).cast("long").alias("_t"),
        *[((F.col(y).cast("int") == a) & (F.col(pred).cast("int") == p)).cast("long").alias(name)
          for name, a, p in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))])
    counts = ["tn", "fp", "fn", "tp"]
    # one set of running totals carries the confusion counts along
    rt = running_totals(base, ["source"], "score", ["_n", "_t", *counts])
    per = rt.withColumn("ks", _ks()).groupBy("source").agg(F.max("ks").alias("ks"), *[F.max(f"tot_{c}").alias(c) for c in counts])
    return auc_hard(per).select("source", rnd("auc", 5).alias("auc"), rnd("ks", 5).alias("ks"))


def _ks():
    """|cumulative target share - cumulative non-target share| of running totals."""
    return F.abs(safe_div("cum__t", "tot__t") - safe_div(F.col("cum__n") - F.col("cum__t"), F.col("tot__n") - F.col("tot__t")))


def role_comparison(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Per source the confusion matrix, AUC (4 dp), accuracy, and the classification report's
    precision, recall, f1 (6 dp) and support of both classes, in one row."""
    cm = auc_hard(confusion_matrix(df, y, pred, ["source"]))
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    block = []
    for label, hit, false, missed in (("0", "tn", "fn", "fp"), ("1", "tp", "fp", "fn")):
        precision = F.coalesce(safe_div(hit, F.col(hit) + F.col(false)), F.lit(0.0))
        recall = F.coalesce(safe_div(hit, F.col(hit) + F.col(missed)), F.lit(0.0))
        f1 = F.coalesce(safe_div(2 * precision * recall, precision + recall), F.lit(0.0))
        block += [rnd(precision, 6).alias(f"precision_{label}"), rnd(recall, 6).alias(f"recall_{label}"), rnd(f1, 6).alias(f"f1_{label}"),
                  (F.col(hit) + F.col(missed)).alias(f"support_{label}")]
    return cm.select("source", "tn", "fp", "fn", "tp", rnd("auc", 4).alias("auc"),
                     rnd(safe_div(F.col("tn") + F.col("tp"), n), 4).alias("accuracy"), *block)
