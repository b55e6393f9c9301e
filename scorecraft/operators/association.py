"""Association and multicollinearity.

Chi-square and Cramér's V are expressions over the contingency table.
Correlations and VIF come from one blocked pass of masked moments (``gram``); only
k x k matrices reach the driver, where numpy inverts them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import chi2_sf, rnd
from .gram import complete_moments, pairwise_correlation


def chi_square(ct: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """C1+C2: per feature the chi-square statistic of levels x target (0/1).

    Expected = row total x column total / n; Yates' correction (|O-E|
    reduced by min(0.5, |O-E|)) only when dof = 1, as scipy does.
    Output: (keys..., feature, chi_square, dof, p_value, n, r, k).
    """
    w = Window.partitionBy(*keys, "feature")  # levels of one feature: a few rows
    t = ct.select(*keys, "feature", "n", "n0", "n1",
                  F.sum("n").over(w).alias("_tot"), F.sum("n0").over(w).alias("_c0"),
                  F.sum("n1").over(w).alias("_c1"), F.count(F.lit(1)).over(w).alias("_r"))
    t = t.withColumn("_k", (F.col("_c0") > 0).cast("int") + (F.col("_c1") > 0).cast("int"))
    t = t.withColumn("_dof", (F.col("_r") - 1) * (F.col("_k") - 1))

    def term(obs, colsum):
        e = F.col("n") * F.col(colsum) / F.col("_tot")
        d = F.abs(F.col(obs) - e)
        d = F.when(F.col("_dof") == 1, d - F.least(F.lit(0.5), d)).otherwise(d)
        return F.when(e > 0, d * d / e).otherwise(F.lit(0.0))

    t = t.withColumn("_term", term("n0", "_c0") + term("n1", "_c1"))
    agg = t.groupBy(*keys, "feature").agg(
        F.sum("_term").alias("chi_square"), F.first("_dof").alias("dof"),
        F.first("_tot").alias("n"), F.first("_r").alias("r"), F.first("_k").alias("k"))
    agg = agg.withColumn("chi_square", F.when(F.col("dof") > 0, F.col("chi_square")).otherwise(F.lit(0.0)))
    return agg.withColumn("p_value", F.when(F.col("dof") > 0, chi2_sf("chi_square", "dof"))
                          .otherwise(F.lit(1.0)))


def cramers_v(chi: DataFrame) -> DataFrame:
    """Bias-corrected Cramér's V, 4 dp, 0 when the denominator is 0."""
    n, r, k, c = F.col("n"), F.col("r"), F.col("k"), F.col("chi_square")
    phi2 = F.greatest(F.lit(0.0), c / n - (k - 1) * (r - 1) / (n - 1))
    rc = r - (r - 1) * (r - 1) / (n - 1)
    kc = k - (k - 1) * (k - 1) / (n - 1)
    den = F.least(kc - 1, rc - 1)
    v = F.when(den == 0, F.lit(0.0)).when(den > 0, rnd(F.sqrt(phi2 / den), 4))
    return chi.withColumn("cramers_v", F.when(n > 1, v).otherwise(F.lit(0.0)))


def cramersv_filter(cv: DataFrame, cardinality: DataFrame, threshold: float = 0.5,
                    max_levels: int = 15) -> DataFrame:
    """C4: (feature, cramers_v, n_unique_with_null, eliminate).

    A feature is eliminated when it has more than ``max_levels`` distinct
    values (NULL counted) or when V <= threshold.
    """
    j = cardinality.select("feature", "n_unique_with_null").join(cv.select("feature", "cramers_v"),
                                                                  "feature", "left")
    too_many = F.col("n_unique_with_null") > max_levels
    return j.select("feature", F.when(too_many, F.lit(None)).otherwise(F.col("cramers_v")).alias("cramers_v"),
                    "n_unique_with_null",
                    (too_many | (F.col("cramers_v") <= threshold)).alias("eliminate"))


def cramersv_by_source(chi: DataFrame, sources: Sequence[str] = ("Test", "OOT", "PDV")) -> DataFrame:
    """Chi-square (4 dp), p-value (4 dp), V per feature, one column group per source."""
    cv = cramers_v(chi).where(F.col("source").isin(*sources))
    return (cv.groupBy("feature").pivot("source", list(sources))
            .agg(F.first(rnd("chi_square", 4)).alias("chi_square"),
                 F.first(rnd("p_value", 4)).alias("p_value"),
                 F.first("cramers_v").alias("cramers_v")))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation, pairwise-complete (NULL in either column skips the row).

    All pairs from one blocked pass (``gram.pairwise_correlation``); long output
    (feature1, feature2, corr) over all ordered pairs, diagonal 1, NULL where a
    correlation is undefined.
    """
    cols = list(cols)
    if not cols:
        return df.sparkSession.createDataFrame([], "feature1 string, feature2 string, corr double")
    r = pairwise_correlation(df, cols)
    rows = [(a, b, 1.0 if i == j else None if np.isnan(r[i, j]) else float(r[i, j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "feature1 string, feature2 string, corr double")


def correlated_pairs(corr: DataFrame, iv: DataFrame, threshold: float = 0.5) -> DataFrame:
    """For each ordered pair with corr > threshold (signed) the lower-IV feature.

    On an IV tie the first of the pair is eliminated (so both, over the two
    orders). Output: distinct (feature) to eliminate.
    """
    iv1 = iv.select(F.col("feature").alias("feature1"), F.col("iv").alias("iv1"))
    iv2 = iv.select(F.col("feature").alias("feature2"), F.col("iv").alias("iv2"))
    pairs = (corr.where((F.col("feature1") != F.col("feature2")) & (F.col("corr") > threshold))
             .join(iv1, "feature1", "left").join(iv2, "feature2", "left"))
    elim = F.when(F.coalesce(F.col("iv1"), F.lit(0.0)) > F.coalesce(F.col("iv2"), F.lit(0.0)),
                  F.col("feature2")).otherwise(F.col("feature1"))
    return pairs.select(elim.alias("feature")).distinct()


def vif(df: DataFrame, cols: Sequence[str], with_const: bool = True) -> DataFrame:
    """Variance inflation factors, sorted desc.

    VIF_i = [R^-1]_ii (R = correlation matrix); the constant's
    VIF = n [(X'X)^-1]_00 = 1 + n/(n-1) z' R^-1 z with z the means over the
    standard deviations.
    """
    cols = list(cols)
    n, m, cov = complete_moments(df, cols)
    sd = np.sqrt(np.diag(cov))
    corr = cov / np.outer(sd, sd)
    inv = np.linalg.pinv(corr)
    rows = [(c, float(inv[i, i])) for i, c in enumerate(cols)]
    if with_const:
        z = m / sd  # by R, as columns of very different sizes would cost S^-1 its digits
        rows.append(("const", float(1.0 + n / (n - 1) * z @ inv @ z)))
    out = df.sparkSession.createDataFrame(rows, "feature string, vif double")
    return out.orderBy(F.desc("vif"))


def vif_filter(v: DataFrame, threshold: float = 10.0) -> DataFrame:
    """Flag VIF >= threshold (nothing is removed, as in the reference)."""
    return v.select("*", (F.col("vif") >= threshold).alias("high_vif"))
