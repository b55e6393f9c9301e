"""SQL text for the DuckDB oracle of each registered query.

The oracle recomputes every statistic from the raw parquet tables with plain
SQL, independently of the Spark code path: quantiles via ``quantile_cont``,
cuts via list filters, shares via window sums. Float outputs are rounded on
both sides (6 dp, or the reference's own precision) and ``+ 0.0`` folds
negative zeros.
"""

from __future__ import annotations

from collections.abc import Sequence

from ..sources.fixtures import LOANS_SQL, ROLES_SQL

BASE = f"loans AS ({LOANS_SQL}),\nr AS ({ROLES_SQL})"


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join([BASE, *ctes]) + "\n"


def r6(x: str, dp: int = 6) -> str:
    return f"(round({x}, {dp}) + 0.0)"


def plist(probs: Sequence[float]) -> str:
    return "[" + ", ".join(repr(float(p)) for p in probs) + "]"


def unpivot(src: str, cols: Sequence[str], keep: Sequence[str], name: str = "feature",
            value: str = "x", cast: str | None = None) -> str:
    """DuckDB UNPIVOT (NULL values dropped)."""
    sel = ", ".join([*keep, *[(f"CAST({c} AS {cast}) AS {c}" if cast else c) for c in cols]])
    return f"(UNPIVOT (SELECT {sel} FROM {src}) ON {', '.join(cols)} INTO NAME {name} VALUE {value})"


def edges_cte(name: str, src: str, cols: Sequence[str], probs: Sequence[float],
              keys: Sequence[str] = (), distinct: bool = True) -> str:
    """name(keys..., feature, q, e): interpolated quantiles (9 dp) and sorted distinct edges."""
    kk = "".join(f"{k}, " for k in keys)
    q = f"list_transform(quantile_cont(x, {plist(probs)}), lambda v: round(v, 9))"
    e = f"list_sort(list_distinct(q))" if distinct else "q"
    return (f"{name} AS (SELECT *, {e} AS e FROM (SELECT {kk}feature, {q} AS q "
            f"FROM {unpivot(src, cols, keys, cast='DOUBLE')} GROUP BY ALL))")


def cut_sql(x: str, e: str, include_lowest: bool = True) -> str:
    """Right-closed bin index of x on a sorted edge list e (1-based DuckDB list)."""
    low = f"{x} < {e}[1]" if include_lowest else f"{x} <= {e}[1]"
    return (f"CASE WHEN len({e}) < 2 OR {x} IS NULL OR {low} OR {x} > {e}[len({e})] THEN NULL "
            f"ELSE CAST(greatest(len(list_filter({e}, lambda v: v < {x})) - 1, 0) AS INTEGER) END")


def hist_sql(x: str, e: str) -> str:
    """numpy.histogram bin of x: left-closed, last bin closed."""
    return (f"CASE WHEN len({e}) < 2 OR {x} IS NULL OR {x} < {e}[1] OR {x} > {e}[len({e})] THEN NULL "
            f"ELSE CAST(least(len(list_filter({e}, lambda v: v <= {x})) - 1, len({e}) - 2) AS INTEGER) END")


def ct_numeric_cte(name: str, src: str, cols: Sequence[str], edges: str,
                   keys: Sequence[str] = (), y: str = "y", include_lowest: bool = True,
                   edge_keys: Sequence[str] = ()) -> str:
    """name(keys..., feature, bin, level, n, n1, n0) for numeric columns cut on ``edges``."""
    kk = "".join(f"{k}, " for k in keys)
    on = " AND ".join([f"u.feature = ed.feature", *[f"u.{k} = ed.{k}" for k in edge_keys]])
    kq = "".join(f"u.{k}, " for k in keys)
    return (f"{name} AS (SELECT {kk}feature, bin, CAST(NULL AS VARCHAR) AS level, "
            f"CAST(count(*) AS BIGINT) AS n, CAST(sum(y) AS BIGINT) AS n1, "
            f"CAST(count(*) - sum(y) AS BIGINT) AS n0 FROM ("
            f"SELECT {kq}u.feature, u.{y} AS y, {cut_sql('u.x', 'ed.e', include_lowest)} AS bin "
            f"FROM {unpivot(src, cols, [*keys, y], cast='DOUBLE')} u JOIN {edges} ed ON {on}) "
            f"WHERE bin IS NOT NULL GROUP BY ALL)")


def ct_categorical_cte(name: str, src: str, cols: Sequence[str], keys: Sequence[str] = (),
                       y: str = "y") -> str:
    kk = "".join(f"{k}, " for k in keys)
    return (f"{name} AS (SELECT {kk}feature, CAST(NULL AS INTEGER) AS bin, level, "
            f"CAST(count(*) AS BIGINT) AS n, CAST(sum({y}) AS BIGINT) AS n1, "
            f"CAST(count(*) - sum({y}) AS BIGINT) AS n0 "
            f"FROM {unpivot(src, cols, [*keys, y], name='feature', value='level', cast='VARCHAR')} GROUP BY ALL)")


def woe_cte(name: str, ct: str, keys: Sequence[str] = ()) -> str:
    """W1 over a contingency CTE."""
    part = ", ".join([*keys, "feature"])
    return (f"{name} AS (SELECT *, CASE WHEN pct0 > 0 AND pct1 > 0 THEN ln(pct0 / pct1) ELSE 0.0 END AS woe "
            f"FROM (SELECT *, CASE WHEN tot0 <> 0 THEN n0 / tot0 END AS pct0, "
            f"CASE WHEN tot1 <> 0 THEN n1 / tot1 END AS pct1 FROM ("
            f"SELECT *, sum(n0) OVER (PARTITION BY {part}) AS tot0, sum(n1) OVER (PARTITION BY {part}) AS tot1 "
            f"FROM {ct})))")
