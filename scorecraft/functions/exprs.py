"""Column expressions shared by the operators.

Everything here is a native Spark expression (no UDF), so it stays inside
whole-stage codegen. Divisions and logarithms are guarded with CASE because
Spark 4 runs with ANSI on (``1/0`` raises, ``ln(0)`` is NULL) while the
reference replaces non-finite terms by 0.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EDGE_DP = 9  # edges are stored rounded to 9 dp so every engine bins alike


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL."""
    num, den = col(num), col(den)
    return F.when(den != 0, num / den)


def ln_ratio(num, den) -> Column:
    """ln(num / den) when both are > 0, else NULL."""
    num, den = col(num), col(den)
    return F.when((num > 0) & (den > 0), F.ln(num / den))


def woe(num, den) -> Column:
    """Weight of evidence ln(num/den); non-finite -> 0 (reference rule)."""
    return F.coalesce(ln_ratio(num, den), F.lit(0.0))


def psi_term(a, e) -> Column:
    """(a - e) * ln(a / e); non-finite -> 0."""
    a, e = col(a), col(e)
    return F.when((a > 0) & (e > 0), (a - e) * F.ln(a / e)).otherwise(F.lit(0.0))


def rnd(c, dp: int) -> Column:
    """Round half-up (as Spark and DuckDB do) and fold -0.0 into 0.0."""
    return F.round(col(c), dp) + F.lit(0.0)


def clean_double(c) -> Column:
    """NaN -> NULL, so Spark has one missing value like pandas."""
    c = col(c).cast("double")
    return F.when(~F.isnan(c), c)


# --------------------------------------------------------------------------
# Interval cuts. pandas cut/qcut are right-closed (a, b]; Spark's Bucketizer
# is left-closed, so the CASE is generated here.
# --------------------------------------------------------------------------

def round_edges(edges: Sequence[float]) -> list[float]:
    return [round(float(e), EDGE_DP) for e in edges]


def cut(x, edges: Sequence[float], include_lowest: bool = True) -> Column:
    """Bin index of x for right-closed intervals (e_i, e_{i+1}].

    ``include_lowest`` also puts ``x == e_0`` in bin 0. Values outside the
    edges, and NULLs, give NULL. Fewer than two edges -> NULL everywhere.
    """
    x = col(x)
    edges = list(edges)
    if len(edges) < 2:
        return F.lit(None).cast("int")
    low_ok = (x >= edges[0]) if include_lowest else (x > edges[0])
    expr = F.when(~low_ok | x.isNull(), F.lit(None).cast("int"))
    for i, e in enumerate(edges[1:]):
        expr = expr.when(x <= e, F.lit(i))
    return expr


def hist(x, edges: Sequence[float]) -> Column:
    """numpy.histogram bins: [e_i, e_{i+1}) with the last bin closed."""
    x = col(x)
    edges = list(edges)
    if len(edges) < 2:
        return F.lit(None).cast("int")
    last = len(edges) - 2
    expr = F.when((x < edges[0]) | (x > edges[-1]) | x.isNull(), F.lit(None).cast("int"))
    for i in range(last):
        expr = expr.when(x < edges[i + 1], F.lit(i))
    return expr.otherwise(F.lit(last))


def interval_label(lo, hi, closed_left: bool = False) -> Column:
    """pandas-like label '(lo, hi]' built from bin-table columns."""
    left = "[" if closed_left else "("
    return F.concat(F.lit(left), col(lo).cast("string"), F.lit(", "),
                    col(hi).cast("string"), F.lit("]"))


# --------------------------------------------------------------------------
# Chi-square upper tail in closed form (integer dof).
# erfc uses the Chebyshev fit of Press et al., "Numerical Recipes" (erfcc,
# fractional error below 1.2e-7), written as SQL so Spark and the DuckDB
# oracle evaluate the same formula.
# --------------------------------------------------------------------------

# The published erfcc coefficients, in order.
_ERFCC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
          0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def erfc_sql(z: str) -> str:
    """SQL text of erfc(z) for z >= 0."""
    t = f"(1.0 / (1.0 + 0.5 * ({z})))"
    poly = f"{_ERFCC[-1]}"
    for c in reversed(_ERFCC[:-1]):
        poly = f"({c} + {t} * {poly})"
    return f"({t} * exp(-({z}) * ({z}) + {poly}))"


def chi2_sf_sql(x: str, dof: str) -> str:
    """SQL text of P(X > x) for X ~ chi2(dof), dof a positive integer.

    Even dof: exp(-x/2) * sum_{j < dof/2} (x/2)^j / j!.
    Odd dof: erfc(sqrt(x/2)) + exp(-x/2) * sum_{j=1}^{(dof-1)/2} (x/2)^(j-1/2) / Gamma(j+1/2).
    Each term is the exponential of a running sum of logarithms less x/2, so
    neither the powers overflow nor exp(-x/2) underflows at any dof.
    """
    h = f"(({x}) / 2.0)"

    def series(m: str, start: str, total: str, divisor: str) -> str:
        steps = f"CASE WHEN {m} >= 1 THEN sequence(1, {m}) ELSE CAST(array() AS array<int>) END"
        grown = f"(acc.l + ln({h} / {divisor}))"
        return (f"aggregate({steps}, struct({start} AS l, {total} AS total), "
                f"(acc, j) -> struct({grown} AS l, acc.total + exp({grown} - {h}) AS total), acc -> acc.total)")

    even = series(f"(CAST(({dof}) / 2 AS INT) - 1)", "0.0D", f"exp(-{h})", "j")
    # term 0 of the odd series, (x/2)^(-1/2) / Gamma(1/2), only starts the running sum
    odd = (f"{erfc_sql(f'sqrt({h})')} + "
           + series(f"CAST((({dof}) - 1) / 2 AS INT)", f"(-0.5D * ln({h}) - {math.lgamma(0.5)!r}D)", "0.0D", "(j - 0.5D)"))
    return (f"CASE WHEN ({dof}) IS NULL OR ({dof}) <= 0 OR ({x}) IS NULL THEN NULL "
            f"WHEN ({x}) <= 0 THEN 1.0D "
            f"WHEN ({dof}) % 2 = 0 THEN {even} ELSE {odd} END")


def chi2_sf(x, dof) -> Column:
    """Column version of :func:`chi2_sf_sql` (x, dof given as column names)."""
    return F.expr(chi2_sf_sql(x, dof))
