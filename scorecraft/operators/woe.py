"""Weight of evidence and information value.

All of them are expressions over the contingency table
(:func:`scorecraft.operators.profile.contingency`), whose size is
#sources x #features x #bins - independent of the row count. Window sums
partition by (source, feature), never over the whole table.

Orientation (T2): y = 1 is the ``level1`` class; the IV step's "good" is
Level0 (y = 0), so W1's WOE is ln(pct0 / pct1). The report (W5) counts
predicted 1s as Goods. IV is symmetric either way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import MISSING_LEVEL
from ..functions.exprs import ln_ratio, rnd, safe_div, woe
from . import binning
from .lookup import replace_levels
from .profile import contingency


def woe_table(ct: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per bin pct0 = n0/tot0, pct1 = n1/tot1, woe = ln(pct0/pct1) (0 if not finite), iv."""
    w = Window.partitionBy(*keys, "feature")
    t = ct.select("*", F.sum("n0").over(w).alias("tot0"), F.sum("n1").over(w).alias("tot1"))
    t = t.select("*", safe_div("n0", "tot0").alias("pct0"), safe_div("n1", "tot1").alias("pct1"))
    return t.select("*", woe("pct0", "pct1").alias("woe")).withColumn(
        "iv", F.coalesce((F.col("pct0") - F.col("pct1")) * F.col("woe"), F.lit(0.0)))


def feature_iv(ct: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sum of W1's iv per feature."""
    return woe_table(ct, keys).groupBy(*keys, "feature").agg(F.sum("iv").alias("iv"))


def iv_report(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], y: str = "y",
              k: int = 5, keys: Sequence[str] = (), method: str = "exact",
              accuracy: int = 10000) -> tuple[DataFrame, dict]:
    """IV per feature - numeric through k quantile bins, categorical by level.

    Returns (iv table (keys..., feature, iv) sorted by iv desc, fitted edges).
    Features with no non-NULL value get IV 0.
    """
    edges = binning.edges_dict(binning.quantile_edges(df, numeric, k, method=method, accuracy=accuracy)) if numeric else {}
    binned = {f: binning.cut(F.col(f), edges.get(f, []), True) for f in numeric}
    ct = contingency(df, binned, categorical, y, keys)
    iv = feature_iv(ct, keys)
    if not keys:  # a feature with no non-NULL value still gets a row, IV 0
        feats = df.sparkSession.createDataFrame([(f,) for f in [*numeric, *categorical]], "feature string")
        iv = feats.join(iv, "feature", "left")
    out = iv.select(*keys, "feature", F.coalesce("iv", F.lit(0.0)).alias("iv"))
    return out.orderBy(F.desc("iv"), "feature"), edges


def iv_filter(iv: DataFrame, threshold: float = 0.02) -> DataFrame:
    """Features kept (IV > threshold) and dropped, as (feature, iv, keep)."""
    return iv.select("*", (F.col("iv") > threshold).alias("keep"))


def woe_encoder_table(df: DataFrame, cols: Sequence[str], y: str = "y", reg: float = 1.0,
                      keys: Sequence[str] = ()) -> DataFrame:
    """W4 fit: per level ln(((n1+reg)/(N1+2reg)) / ((n0+reg)/(N0+2reg))).

    NULL levels become 'missing' first; a level seen once encodes to 0.
    """
    filled = df.select(*keys, y, *[F.coalesce(F.col(c).cast("string"), F.lit("missing")).alias(c) for c in cols])
    ct = contingency(filled, {}, cols, y, keys)
    w = Window.partitionBy(*keys, "feature")
    t = ct.select("*", F.sum("n1").over(w).alias("tot1"), F.sum("n0").over(w).alias("tot0"))
    val = F.ln(((F.col("n1") + reg) / (F.col("tot1") + 2 * reg))
               / ((F.col("n0") + reg) / (F.col("tot0") + 2 * reg)))
    return t.select(*keys, "feature", "level", F.when(F.col("n") > 1, val).otherwise(F.lit(0.0)).alias("woe"))


def woe_encode(df: DataFrame, table: DataFrame, cols: Sequence[str]) -> DataFrame:
    """W4 transform: replace each level by its WOE; unknown levels -> 0 (see ``lookup``)."""
    return replace_levels(df, table, cols, "woe", 0.0, null_level=MISSING_LEVEL)


def bin_performance(ct: DataFrame, keys: Sequence[str] = ("source",)) -> DataFrame:
    """Per feature and bin the report columns (T15 rounding order).

    ``ct`` must carry n (Total) and n1 (Goods = predicted 1s). Shares are
    rounded to 4 dp; WOE = round(ln(Good_Percent/Bad_Percent), 4) from the
    rounded shares (+-inf -> 0, 0/0 -> NULL); IV multiplies the unrounded
    share difference by that WOE and is rounded to 4 dp.
    """
    w = Window.partitionBy(*keys, "feature")
    t = ct.select(*keys, "feature", "bin", "level", F.col("n").alias("Total"), F.col("n1").alias("Goods"),
                  (F.col("n") - F.col("n1")).alias("Bads"))
    t = t.select("*", F.sum("Total").over(w).alias("_tot"), F.sum("Goods").over(w).alias("_good"),
                 F.sum("Bads").over(w).alias("_bad"))
    gp = rnd(safe_div("Goods", "_good"), 4)
    bp = rnd(safe_div("Bads", "_bad"), 4)
    t = t.select("*", rnd(safe_div("Total", "_tot"), 4).alias("Pop_Percent"),
                 rnd(safe_div("Goods", "Total"), 4).alias("Good_Rate"),
                 rnd(safe_div("Bads", "Total"), 4).alias("Bad_Rate"),
                 gp.alias("Good_Percent"), bp.alias("Bad_Percent"))
    # ln(a/b): a,b > 0 -> value; exactly one of them 0 -> +-inf -> 0; both 0 -> NaN -> NULL
    g, b = F.col("Good_Percent"), F.col("Bad_Percent")
    w_expr = (F.when((g > 0) & (b > 0), rnd(F.ln(g / b), 4))
              .when((g == 0) & (b == 0), F.lit(None).cast("double"))
              .otherwise(F.lit(0.0)))
    t = t.withColumn("WOE", w_expr)
    diff = safe_div("Goods", "_good") - safe_div("Bads", "_bad")
    t = t.withColumn("IV", rnd(diff * F.col("WOE"), 4))
    return t.drop("_tot", "_good", "_bad")


ROLES = ("Test", "OOT", "PDV")


def roles_present(df: DataFrame, roles: Sequence[str] = ROLES) -> list[str]:
    """Those of ``roles`` that ``df`` has rows of, in their order (one small aggregate)."""
    have = {r["source"] for r in df.where(F.col("source").isin(*roles)).select("source").distinct().collect()}
    return [r for r in roles if r in have]


def iv_by_source(perf: DataFrame, sources: Sequence[str] | None = None) -> DataFrame:
    """IV per feature and source side by side, features present in all; by the first source's IV desc.

    ``sources`` defaults to the roles the data has besides Train; none gives an empty table."""
    sources = list(sources or roles_present(perf) or ROLES)
    agg = perf.where(F.col("source").isin(*sources)).groupBy("feature").pivot("source", list(sources)) \
        .agg(F.sum("IV"))
    cols = [rnd(F.col(s), 4).alias(f"IV_{s}") for s in sources]
    out = agg.select("feature", *cols)
    for s in sources:
        out = out.where(F.col(f"IV_{s}").isNotNull())
    return out.orderBy(F.desc(f"IV_{sources[0]}"), "feature")


def bivariate_series(perf: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Numbered bin label, population % and Bad_Percent x 100 (2 dp) per source and feature."""
    w = Window.partitionBy("source", "feature").orderBy("bin", "level")
    t = perf.select("*", F.row_number().over(w).alias("bin_no"))
    if labels is not None:
        t = t.join(labels.select("feature", "bin", "label"), ["feature", "bin"], "left")
        lab = F.coalesce(F.col("label"), F.col("level"), F.col("bin").cast("string"))
    else:
        lab = F.coalesce(F.col("level"), F.col("bin").cast("string"))
    return t.select("source", "feature", "bin_no",
                    F.concat(F.col("bin_no").cast("string"), F.lit(". "), lab).alias("bin_label"),
                    rnd(F.col("Pop_Percent") * 100, 2).alias("population_pct"),
                    rnd(F.col("Bad_Percent") * 100, 2).alias("bad_pct"))


def log_odds(num, den):
    """ln(num/den) guarded (re-exported for flows)."""
    return ln_ratio(num, den)
