"""Population / characteristic stability.

Baseline and current data are one DataFrame with a ``source`` column, so
both sides are binned and counted in the same scan and the same shuffle;
shares and PSI terms are then computed on the (feature, bin, source) count
table, which is tiny.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import cut, hist, psi_term, rnd, safe_div
from . import binning
from .profile import contingency


def _side_by_side(ct: DataFrame, key: str, base: str, cur: str) -> DataFrame:
    """(feature, key, e, a): the shares of base and current rows, one row per bin or level
    that either has, from the counts of one scan."""
    n = {side: F.sum(F.when(F.col("source") == role, F.col("n")).otherwise(0)).alias(f"n_{side}") for side, role in (("e", base), ("a", cur))}
    w = Window.partitionBy("feature")  # bins or levels of one feature
    return (ct.where(F.col(key).isNotNull()).groupBy("feature", key).agg(n["e"], n["a"])
            .select("feature", key, *[F.coalesce(safe_div(f"n_{x}", F.sum(f"n_{x}").over(w)), F.lit(0.0)).alias(x) for x in "ea"]))


def psi_equal_width(base: DataFrame, cur: DataFrame, cols: Sequence[str], k: int = 10) -> DataFrame:
    """Equal-width PSI (B7 edges over both sets, right-closed, lowest excluded).

    Terms are (E - A) ln(E / A) over all bins; a bin empty on one
    side makes the reference's sum non-finite - reported here as NULL psi
    with ``n_nonfinite`` > 0.
    """
    edges = binning.edges_dict(binning.equal_width_edges(base, cur, cols, k))
    both = (base.select(*cols).withColumn("source", F.lit("E")).unionByName(cur.select(*cols).withColumn("source", F.lit("A"))))
    ct = contingency(both.withColumn("_one", F.lit(0.0)),
                     {c: cut(F.col(c), edges[c], include_lowest=False) for c in cols}, [], "_one", ["source"])
    bins = binning.bin_table(edges, base.sparkSession, include_lowest=False).select("feature", "bin")
    j = bins.join(_side_by_side(ct, "bin", "E", "A"), ["feature", "bin"], "left").fillna(0.0, ["e", "a"])
    finite = (F.col("e") > 0) & (F.col("a") > 0)
    t = j.select("feature", F.when(finite, (F.col("e") - F.col("a")) * F.ln(F.col("e") / F.col("a")))
                 .alias("term"), (~finite).cast("int").alias("bad"))
    out = t.groupBy("feature").agg(F.sum("term").alias("psi"), F.sum("bad").alias("n_nonfinite"))
    return out.select("feature", F.when(F.col("n_nonfinite") == 0, rnd("psi", 6)).alias("psi"),
                      F.col("n_nonfinite").cast("long").alias("n_nonfinite"))


def csi_numeric(df: DataFrame, cols: Sequence[str], base: str = "Train", cur: str = "Test") -> DataFrame:
    """Decile-histogram CSI of numeric columns, 4 dp.

    Edges = baseline quantiles 0.1..1.0 (9 left-closed bins, last closed);
    terms (A - E) ln(A / E) with non-finite -> 0.
    """
    return csi_report(df, cols, [], base, cur)


def csi_categorical(df: DataFrame, cols: Sequence[str], base: str = "Train", cur: str = "Test") -> DataFrame:
    """D3: level-share CSI on the union of levels (NULL levels ignored), 4 dp."""
    return csi_report(df, [], cols, base, cur)


# Free-text and index columns that the reference's report leaves out (fixed values)
SKIP = ("Unnamed: 0", "emp_title", "title")


def csi_report(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
               base: str = "Train", cur: str = "Test", skip: Sequence[str] = ()) -> DataFrame:
    """One CSI row per feature (numeric via D2, categorical via D3) outside ``skip``.

    After the edges are known, one scan counts every feature's bins and levels
    of both roles.
    """
    num, cat = [c for c in numeric if c not in skip], [c for c in categorical if c not in skip]
    edges = {r["feature"]: r["edges"] for r in binning.decile_edges(df.where(F.col("source") == base), num).collect()} if num else {}
    two = df.where(F.col("source").isin(base, cur)).withColumn("_z", F.lit(0.0))
    ct = contingency(two, {c: hist(F.col(c), edges.get(c, [])) for c in num}, cat, "_z", ["source"])
    j = _side_by_side(ct.withColumn("key", F.coalesce(F.col("bin").cast("string"), F.col("level"))), "key", base, cur)
    return j.groupBy("feature").agg(rnd(F.sum(psi_term("a", "e")), 4).alias("csi"))


def csi_detail(perf: DataFrame, ref: str = "Test", others: Sequence[str] = ("OOT", "PDV")) -> DataFrame:
    """D5 over a (source, feature, bin, level, Pop_Percent) table; null-safe keys."""
    p = perf.select("source", "feature", F.coalesce(F.col("bin").cast("string"), F.col("level")).alias("bin_key"),
                    "Pop_Percent")
    wide = p.groupBy("feature", "bin_key").pivot("source", [ref, *others]).agg(F.first("Pop_Percent"))
    out = wide.select("feature", "bin_key", *[F.col(s).alias(f"Pop_Percent_{s}") for s in [ref, *others]])
    for s in others:
        x = F.col(f"Pop_Percent_{s}")
        tt = F.col(f"Pop_Percent_{ref}")
        term = (F.when(tt.isNull() | x.isNull(), F.lit(None).cast("double"))
                .when((tt > 0) & (x > 0), rnd((tt - x) * F.ln(tt / x), 4))
                .when((tt == 0) & (x == 0), F.lit(None).cast("double"))
                .otherwise(F.lit(0.0)))
        out = out.withColumn(f"PSI_{ref.lower()}_{s.lower()}", term)
    return out


def csi_summary(detail: DataFrame, ref: str = "Test", others: Sequence[str] = ("OOT", "PDV")) -> DataFrame:
    """Per feature the summed PSI terms, 4 dp (NULL terms skipped)."""
    aggs = [rnd(F.sum(f"PSI_{ref.lower()}_{s.lower()}"), 4).alias(f"PSI_{s}") for s in others]
    return detail.where(F.col("feature").isNotNull()).groupBy("feature").agg(*aggs)


def band_table(scored: DataFrame, band: str = "risk_band", y: str = "y",
               sources: Sequence[str] = ("Train", "Test", "OOT", "PDV"), base: str = "Train") -> DataFrame:
    """D7 (+E7): per source and risk band the counts, shares, gain, lift and PSI vs the base.

    Population share divides by all scored rows of the source (rows without
    a band included, T6). Bands are aligned by index, not position (T16).
    """
    # one aggregate; what follows works on #sources x #bands rows
    g = (scored.where(F.col("source").isin(*sources)).groupBy("source", band)
         .agg(F.count(F.lit(1)).alias("Count"), F.sum(y).cast("long").alias("Goods")))
    wall = Window.partitionBy("source")
    everything = Window.partitionBy(F.lit(1))
    is_base = F.col("source") == base
    g = (g.withColumn("_pop", F.sum("Count").over(wall)).where(F.col(band).isNotNull())
         .withColumn("_nb", F.sum(F.when(is_base, 1).otherwise(0)).over(everything)))
    w = Window.partitionBy("source").orderBy(band).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = g.select("source", band, "Count", "Goods", "_nb", (F.col("Count") - F.col("Goods")).alias("Bads"),
                 (F.col("Count") / F.col("_pop")).alias("Population"))
    t = t.select("*", F.sum("Bads").over(w).alias("Cum_Bads"),
                 safe_div("Bads", F.sum("Bads").over(wall)).alias("Cum_Bads_pct"),
                 F.row_number().over(Window.partitionBy("source").orderBy(band)).alias("_i"))
    t = t.withColumn("Gain", rnd(F.sum("Cum_Bads_pct").over(w) * 100.0, 4))
    t = t.withColumn("lift_per_band", F.when(F.col("_nb") > 0, F.col("_i") * (F.lit(100.0) / F.col("_nb"))))
    t = t.withColumn("Lift", safe_div("Gain", "lift_per_band"))
    t = t.withColumn("_pb", F.max(F.when(is_base, F.col("Population"))).over(Window.partitionBy(band)))
    return t.select("source", band, "Count", "Goods", "Bads", rnd("Population", 6).alias("Population"),
                    "Cum_Bads", rnd("Cum_Bads_pct", 6).alias("Cum_Bads_pct"), "Gain",
                    rnd("lift_per_band", 6).alias("lift_per_band"), rnd("Lift", 6).alias("Lift"),
                    rnd(psi_term("_pb", "Population"), 6).alias("PSI"))


def band_psi_total(bands: DataFrame) -> DataFrame:
    """Total PSI per source."""
    return bands.groupBy("source").agg(rnd(F.sum("PSI"), 6).alias("PSI"))
