"""Registered queries: one per operator of SURVEY §2, each over the whole
driver tables (through the loan view), with its DuckDB oracle where one
exists.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``.
Column names match between the two; float columns are rounded on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import rnd
from ..operators import woe as W
from ..sources.fixtures import CATEGORICAL, NUMERIC, loans_roles, staged_roles
from . import sqlkit as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loans_roles(spark, sf_dir).where(F.col("source") == "Train")


def staged_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``train`` for what passes over it many times."""
    return staged_roles(spark, sf_dir).where(F.col("source") == "Train")


TRAIN = "(SELECT * FROM r WHERE source = 'Train')"
P5 = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]


# ---------------------------------------------------------------- W2 flagship
@register("iv_report", S.with_(
    S.edges_cte("ed", TRAIN, NUMERIC, P5),
    S.ct_numeric_cte("ctn", TRAIN, NUMERIC, "ed"),
    S.ct_categorical_cte("ctc", TRAIN, CATEGORICAL),
    S.woe_cte("w", "(SELECT * FROM ctn UNION ALL SELECT * FROM ctc)"),
    "feats AS (SELECT unnest(" + S.plist([]).replace("[]", "[" + ", ".join(f"'{f}'" for f in NUMERIC + CATEGORICAL) + "]") + ") AS feature)")
    + f"SELECT f.feature, {S.r6('coalesce(sum(coalesce((pct0 - pct1) * woe, 0.0)), 0.0)')} AS iv "
      "FROM feats f LEFT JOIN w ON f.feature = w.feature GROUP BY f.feature")
def q_iv_report(spark, sf_dir):
    iv, _ = W.iv_report(train(spark, sf_dir), NUMERIC, CATEGORICAL, "y", 5)
    return iv.select("feature", rnd("iv", 6).alias("iv"))


# ============================================================== shared frames
from ..operators import association as C  # noqa: E402
from ..operators import binning as B  # noqa: E402
from ..operators import performance as E  # noqa: E402
from ..operators import prep as P  # noqa: E402
from ..operators import profile as A  # noqa: E402
from ..operators import stability as D  # noqa: E402
from ..functions.exprs import cut  # noqa: E402
from ..session import stage_dir  # noqa: E402
from ..sources.fixtures import BAD_VALUES, EXCLUDED, loans  # noqa: E402

FEATS = NUMERIC + CATEGORICAL
RP = "rp AS (SELECT * FROM r UNION ALL SELECT * REPLACE ('PDV' AS source) FROM r WHERE source = 'Test' AND l_linenumber <= 2)"
SC = "sc AS (SELECT *, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS pred FROM rp)"


def roles(spark, sf_dir, pdv=False):
    return loans_roles(spark, sf_dir, pdv=pdv)


def scored(spark, sf_dir):
    """All roles (PDV included) with the deterministic score's hard label."""
    return roles(spark, sf_dir, pdv=True).withColumn("pred", E.hard_label("score"))


def forced_sql(name: str, src: str, cols, k: int = 5) -> str:
    """CTE name(feature, e) of B2 forced edges."""
    probs = [i / k for i in range(k + 1)]
    return (S.edges_cte(f"{name}_q", src, cols, probs) + ",\n"
            f"{name} AS (SELECT feature, CASE WHEN len(e) = 2 THEN list_sort(list_distinct(list_concat("
            f"[1.0, round(q[1] / 2, 9)], q[2:]))) ELSE e END AS e FROM {name}_q)")


def binned_scored(spark, sf_dir):
    """Model-style binning of the scored roles: B2 edges fitted on Train, missing -> -1 / 'missing'."""
    s = scored(spark, sf_dir)
    edges = B.edges_dict(B.forced_edges(s.where(F.col("source") == "Train"), NUMERIC, 5))
    b = B.apply_bins(s, edges, include_lowest=True, missing_bin=-1)
    return P.impute_categorical(b, CATEGORICAL), edges


def binned_scored_sql() -> list[str]:
    """CTEs rp, sc, fe (forced edges) and bs (bin codes, long form: source, feature, bin, level, pred, y)."""
    trn = "(SELECT * FROM r WHERE source = 'Train')"
    num = (f"SELECT u.source, u.feature, coalesce({S.cut_sql('u.x', 'fe.e')}, -1) AS bin, "
           f"CAST(NULL AS VARCHAR) AS level, u.pred, u.y FROM "
           f"(UNPIVOT (SELECT source, pred, y, {', '.join(f'coalesce(CAST({c} AS DOUBLE), -1e308) AS {c}' for c in NUMERIC)} FROM sc) "
           f"ON {', '.join(NUMERIC)} INTO NAME feature VALUE x) u JOIN fe ON u.feature = fe.feature")
    cat = (f"SELECT source, feature, CAST(NULL AS INTEGER) AS bin, level, pred, y FROM "
           f"(UNPIVOT (SELECT source, pred, y, {', '.join(f'coalesce({c}, {chr(39)}missing{chr(39)}) AS {c}' for c in CATEGORICAL)} FROM sc) "
           f"ON {', '.join(CATEGORICAL)} INTO NAME feature VALUE level)")
    return [RP, SC, forced_sql("fe", trn, NUMERIC), f"bs AS ({num} UNION ALL {cat})"]


def perf_frame(spark, sf_dir):
    """W5 bin performance per source over the binned scored roles (Goods = predicted 1s)."""
    b, _ = binned_scored(spark, sf_dir)
    ct = A.contingency(b, NUMERIC, CATEGORICAL, "pred", ["source"])
    return W.bin_performance(ct, ["source"])


PERF_SQL = (
    "pf0 AS (SELECT source, feature, bin, level, CAST(count(*) AS BIGINT) AS Total, "
    "CAST(sum(pred) AS BIGINT) AS Goods, CAST(count(*) - sum(pred) AS BIGINT) AS Bads FROM bs GROUP BY ALL)",
    "pf1 AS (SELECT *, sum(Total) OVER (PARTITION BY source, feature) AS _tot, "
    "sum(Goods) OVER (PARTITION BY source, feature) AS _good, sum(Bads) OVER (PARTITION BY source, feature) AS _bad FROM pf0)",
    "pf2 AS (SELECT *, round(Total / _tot, 4) + 0.0 AS Pop_Percent, round(Goods / Total, 4) + 0.0 AS Good_Rate, "
    "round(Bads / Total, 4) + 0.0 AS Bad_Rate, round(CASE WHEN _good <> 0 THEN Goods / _good END, 4) + 0.0 AS Good_Percent, "
    "round(CASE WHEN _bad <> 0 THEN Bads / _bad END, 4) + 0.0 AS Bad_Percent FROM pf1)",
    "pf3 AS (SELECT *, CASE WHEN Good_Percent > 0 AND Bad_Percent > 0 THEN round(ln(Good_Percent / Bad_Percent), 4) + 0.0 "
    "WHEN Good_Percent = 0 AND Bad_Percent = 0 THEN NULL ELSE 0.0 END AS WOE FROM pf2)",
    "perf AS (SELECT source, feature, bin, level, Total, Goods, Bads, Pop_Percent, Good_Rate, Bad_Rate, Good_Percent, "
    "Bad_Percent, WOE, round(((CASE WHEN _good <> 0 THEN Goods / _good END) - (CASE WHEN _bad <> 0 THEN Bads / _bad END)) * WOE, 4) + 0.0 AS IV FROM pf3)",
)


# ============================================================ P: preparation
@register("read_dataset", "SELECT 'Train' AS source, l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n, "
          "CAST(count(l_tax) AS BIGINT) AS with_tax, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM lineitem GROUP BY ALL")
def q_read_dataset(spark, sf_dir):
    """A role file as the flows read it."""
    d = IO.read_dataset(spark, f"{sf_dir}/lineitem.parquet", "Train")
    return d.groupBy("source", "l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.count("l_tax").alias("with_tax"), F.sum("l_orderkey").alias("keys"))


@register("load_roles", S.with_(RP) + "SELECT source, CAST(count(*) AS BIGINT) AS n FROM rp GROUP BY source")
def q_load_roles(spark, sf_dir):
    """S3 then S2: the rows of every role written to a folder of their own and read as role files."""
    d = roles(spark, sf_dir, pdv=True).select("source", *FEATS, "loan_status")
    base = stage_dir(spark, f"role-files-{IO.new_run()}")
    IO.write_cleansed(d, base)
    back = IO.load_roles(spark, *[f"{base}/source={s}" for s in ("Train", "Test", "PDV", "OOT")], fmt="parquet")
    return back.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@register("exclude_columns", S.with_() + "SELECT * EXCLUDE (l_orderkey, l_linenumber, l_shipdate, yTarget, y, score) FROM r")
def q_exclude_columns(spark, sf_dir):
    return P.exclude_columns(roles(spark, sf_dir), EXCLUDED + ["yTarget", "y", "score"])


_NN = " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS non_null FROM r WHERE source = 'Train'"
                         for c in FEATS + ["loan_status"])


@register("drop_all_null_columns", S.with_(f"nn AS ({_NN})") +
          "SELECT column_name, non_null, non_null = 0 AS dropped FROM nn")
def q_drop_all_null_columns(spark, sf_dir):
    t = train(spark, sf_dir)
    cols = FEATS + ["loan_status"]
    row = t.agg(*[F.count(c).alias(c) for c in cols])
    long = row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("long").alias("non_null"))
                                         for c in cols])))
    return long.withColumn("dropped", F.col("column_name").isin(*P.all_null_columns(t, cols)))


_DD = ", ".join(["source", *FEATS, "loan_status"])


@register("drop_duplicate_rows", S.with_() + f"SELECT DISTINCT {_DD} FROM r")
def q_drop_duplicate_rows(spark, sf_dir):
    return P.drop_duplicate_rows(roles(spark, sf_dir).select(*[c.strip() for c in _DD.split(",")]))


@register("derive_target", S.with_() + "SELECT loan_status, yTarget, CAST(count(*) AS BIGINT) AS n FROM r GROUP BY ALL")
def q_derive_target(spark, sf_dir):
    d = P.derive_target(loans(spark, sf_dir), "loan_status", BAD_VALUES, True)
    return d.groupBy("loan_status", "yTarget").agg(F.count(F.lit(1)).alias("n"))


@register("derive_target_multiclass", S.with_() +
          "SELECT CASE WHEN loan_status IN ('Charged Off', 'Default') THEN 'Level0' ELSE loan_status END AS yTarget, "
          "CAST(count(*) AS BIGINT) AS n FROM loans GROUP BY ALL")
def q_derive_target_multiclass(spark, sf_dir):
    d = P.derive_target(loans(spark, sf_dir), "loan_status", BAD_VALUES, False)
    return d.groupBy("yTarget").agg(F.count(F.lit(1)).alias("n"))


@register("encode_target", S.with_() + "SELECT yTarget, y, CAST(count(*) AS BIGINT) AS n FROM r GROUP BY ALL")
def q_encode_target(spark, sf_dir):
    d = P.encode_target(P.derive_target(loans(spark, sf_dir), "loan_status", BAD_VALUES), "yTarget", "y")
    return d.groupBy("yTarget", "y").agg(F.count(F.lit(1)).alias("n"))


@register("target_summary", S.with_(
    "c AS (SELECT source, yTarget, CAST(count(*) AS BIGINT) AS count FROM r GROUP BY ALL)",
    "s AS (SELECT *, round(count / sum(count) OVER (PARTITION BY source), 6) + 0.0 AS share, "
    "CAST(count(*) OVER (PARTITION BY source) AS BIGINT) AS n_classes, "
    "CAST(sum(count) OVER (PARTITION BY source) AS BIGINT) AS n_rows FROM c)")
    + "SELECT source, yTarget, count, share, n_classes, n_rows, n_classes = 2 AS binomial, "
      "min(share) OVER (PARTITION BY source) < 0.1 AS imbalanced, n_classes < 2 AS too_few_classes, "
      "n_rows <= 5000 AS small_sample FROM s")
def q_target_summary(spark, sf_dir):
    return P.target_summary(roles(spark, sf_dir), "yTarget", keys=["source"])


def share_sql(key: str, seed: int) -> str:
    p = "2147483647"
    return f"((((({key}) % {p} + {p}) % {p} * 48271 + {seed}) % {p}) * 48271 % {p} % 10000)"


@register("split_by_key", S.with_() + f"SELECT CASE WHEN {share_sql('l_orderkey', 144)} < 2500 THEN 'Test' ELSE 'Train' END AS source, "
          "CAST(count(*) AS BIGINT) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM loans GROUP BY 1")
def q_split_by_key(spark, sf_dir):
    d = P.split_by_key(loans(spark, sf_dir), "l_orderkey", 0.25, 144)
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys"))


@register("sample_rows", S.with_() + "SELECT l_orderkey, l_linenumber, source, y FROM r "
          f"WHERE {share_sql('l_orderkey * 8 + l_linenumber', 144)} < 1000")
def q_sample_rows(spark, sf_dir):
    d = roles(spark, sf_dir).withColumn("row_key", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    return P.sample_rows(d, 0.1, 144, "row_key").select("l_orderkey", "l_linenumber", "source", "y")


@register("select_features", S.with_() + f"SELECT {', '.join(FEATS)}, y FROM r WHERE source = 'Train'")
def q_select_features(spark, sf_dir):
    return P.select_features(train(spark, sf_dir), FEATS, "y")


def _missing_sql(src: str) -> str:
    parts = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST(count(*) - count({c}) AS BIGINT) AS missing, "
                               f"count(*) AS rows FROM {src}" for c in FEATS)
    return (f"m AS ({parts})",
            "SELECT feature, missing, round(CASE WHEN rows > 0 THEN missing / rows END, 3) + 0.0 AS missing_share, "
            "round(CASE WHEN max(missing) OVER () > 0 THEN missing / max(missing) OVER () END, 3) + 0.0 AS missing_share_max FROM m")


@register("missing_profile", S.with_(_missing_sql(TRAIN)[0]) + _missing_sql(TRAIN)[1])
def q_missing_profile(spark, sf_dir):
    return A.missing_profile(train(spark, sf_dir), FEATS)


@register("drop_high_missing", S.with_(_missing_sql(TRAIN)[0], "mp AS (" + _missing_sql(TRAIN)[1] + ")") +
          "SELECT feature, missing_share, missing_share >= 0.6 AS dropped, missing_share_max >= 0.6 AS dropped_max FROM mp")
def q_drop_high_missing(spark, sf_dir):
    m = A.missing_profile(train(spark, sf_dir), FEATS)
    by_rows, by_most = P.high_missing(m, 0.6), P.high_missing(m, 0.6, "max_missing")
    return m.select("feature", "missing_share", F.col("feature").isin(*by_rows).alias("dropped"),
                    F.col("feature").isin(*by_most).alias("dropped_max"))


_CARD = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST(count(DISTINCT {c}) AS BIGINT) AS nunique FROM {TRAIN}"
                           for c in CATEGORICAL)


@register("drop_high_cardinality", S.with_(f"d AS ({_CARD})") + "SELECT feature, nunique, nunique > 15 AS dropped FROM d")
def q_drop_high_cardinality(spark, sf_dir):
    t = train(spark, sf_dir)
    dropped = P.high_cardinality(t, CATEGORICAL, 15)
    return A.distinct_profile(t, CATEGORICAL).select("feature", "nunique", F.col("feature").isin(*dropped).alias("dropped"))


IMP = NUMERIC


def _impute_sql(fill: str) -> str:
    vals = " UNION ALL ".join(f"SELECT DISTINCT '{c}' AS feature, {fill.format(c=c)} AS value FROM {TRAIN}"
                              for c in IMP)
    sums = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg(coalesce(t.{c}, v.value)) AS filled_mean FROM {TRAIN} t, "
        f"(SELECT value FROM v WHERE feature = '{c}') v" for c in IMP)
    return (S.with_(f"v AS ({vals})", f"s AS ({sums})") +
            f"SELECT v.feature, {S.r6('v.value')} AS value, {S.r6('s.filled_mean', 4)} AS filled_mean "
            "FROM v JOIN s ON v.feature = s.feature")


def _impute_q(how):
    def q(spark, sf_dir):
        t = train(spark, sf_dir)
        vals = P.impute_values(t, IMP, how, -999.0)
        f = P.impute_numeric(t, vals, how)
        sums = f.agg(*[F.avg(c).alias(c) for c in IMP])
        return sums.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"),
                                                        rnd(F.lit(float(vals[c])), 6).alias("value"),
                                                        rnd(F.col(c), 4).alias("filled_mean")) for c in IMP])))
    return q


register("impute_mean", _impute_sql("avg({c})"))(_impute_q("mean"))
register("impute_median", _impute_sql("quantile_cont({c}, 0.5)"))(_impute_q("median"))
register("impute_constant", _impute_sql("-999.0"))(_impute_q("constant"))


@register("impute_drop", S.with_() + "SELECT source, CAST(count(*) AS BIGINT) AS n FROM r WHERE "
          + " AND ".join(f"{c} IS NOT NULL" for c in IMP) + " GROUP BY source")
def q_impute_drop(spark, sf_dir):
    d = P.impute_numeric(roles(spark, sf_dir), {c: 0.0 for c in IMP}, "drop")
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@register("impute_categorical", S.with_() + "SELECT source, feature, level, CAST(count(*) AS BIGINT) AS n FROM " + S.unpivot(
    "(SELECT source, " + ", ".join(f"coalesce({c}, 'missing') AS {c}" for c in CATEGORICAL) + " FROM r)", CATEGORICAL, ["source"],
    value="level") + " GROUP BY ALL")
def q_impute_categorical(spark, sf_dir):
    d = P.impute_categorical(roles(spark, sf_dir), CATEGORICAL)
    return (d.select("source", *CATEGORICAL).unpivot("source", CATEGORICAL, "feature", "level")
            .groupBy("source", "feature", "level").agg(F.count(F.lit(1)).alias("n")))


@register("fill_unbinned_numeric", S.with_() + "SELECT source, " + ", ".join(
    f"{S.r6(f'sum(coalesce({c}, 0))', 4)} AS {c}" for c in IMP) + " FROM r GROUP BY source")
def q_fill_unbinned_numeric(spark, sf_dir):
    d = P.fill_unbinned_numeric(roles(spark, sf_dir), IMP)
    return d.groupBy("source").agg(*[rnd(F.sum(c), 4).alias(c) for c in IMP])


@register("missing_bin", S.with_(*binned_scored_sql()) +
          "SELECT source, feature, bin, level, CAST(count(*) AS BIGINT) AS n FROM bs "
          "WHERE bin = -1 OR level = 'missing' GROUP BY ALL")
def q_missing_bin(spark, sf_dir):
    b, _ = binned_scored(spark, sf_dir)
    ct = A.contingency(b, NUMERIC, CATEGORICAL, "y", ["source"])
    return ct.where((F.col("bin") == -1) | (F.col("level") == "missing")).select("source", "feature", "bin", "level", "n")


GROUPS = {"PROMO": "Promotional", "STANDARD": "Core", "ECONOMY": "Core"}


@register("group_categories", S.with_(
    "seen AS (SELECT DISTINCT p_type AS level FROM r WHERE source = 'Train' AND p_type IS NOT NULL)",
    "m AS (SELECT level, CASE level " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in GROUPS.items())
    + " ELSE level END AS grouped FROM seen)")
    + "SELECT r.source, coalesce(m.grouped, 'missing') AS p_type, CAST(count(*) AS BIGINT) AS n "
      "FROM r LEFT JOIN m ON r.p_type = m.level GROUP BY ALL")
def q_group_categories(spark, sf_dir):
    d = roles(spark, sf_dir)
    m = P.category_map(d.where(F.col("source") == "Train"), "p_type", GROUPS)
    g = P.group_categories(d, "p_type", m)
    return g.groupBy("source", "p_type").agg(F.count(F.lit(1)).alias("n"))


TRANS = {"l_extendedprice": "log", "l_quantity": "sqrt", "l_discount": "recip"}


@register("transform_numeric", S.with_() + "SELECT source, "
          f"{S.r6('sum(CASE WHEN l_extendedprice > 0 THEN ln(l_extendedprice) END)', 4)} AS l_extendedprice, "
          f"{S.r6('sum(CASE WHEN l_quantity >= 0 THEN sqrt(l_quantity) END)', 4)} AS l_quantity, "
          f"{S.r6('sum(CASE WHEN l_discount <> 0 THEN 1.0 / l_discount ELSE 0.0 END)', 4)} AS l_discount "
          "FROM r GROUP BY source")
def q_transform_numeric(spark, sf_dir):
    d = P.transform_numeric(roles(spark, sf_dir), TRANS)
    return d.groupBy("source").agg(*[rnd(F.sum(c), 4).alias(c) for c in TRANS])


@register("role_filter", S.with_(*binned_scored_sql(), *PERF_SQL) +
          "SELECT source, feature, level, Total, Pop_Percent FROM perf WHERE source = 'OOT' AND feature = 'p_type'")
def q_role_filter(spark, sf_dir):
    return P.role_filter(perf_frame(spark, sf_dir), "OOT", "p_type").select(
        "source", "feature", "level", "Total", "Pop_Percent")


# ============================================================ A: profiling
P9 = [i / 10 for i in range(1, 10)]


@register("describe_numeric", S.with_(
    f"d AS (SELECT feature, count(x) AS count, min(x) AS mn, max(x) AS mx, avg(x) AS mean, stddev_samp(x) AS std, "
    f"quantile_cont(x, {S.plist(P9)}) AS q FROM {S.unpivot(TRAIN, NUMERIC, [], cast='DOUBLE')} GROUP BY feature)")
    + "SELECT feature, CAST(count AS BIGINT) AS count, " + ", ".join(
        [f"{S.r6(a, 2)} AS {b}" for a, b in (("mn", "min"), ("mx", "max"), ("mean", "mean"), ("std", "std"))]
        + [f"{S.r6(f'q[{i + 1}]', 2)} AS p{(i + 1) * 10}" for i in range(9)]) + " FROM d")
def q_describe_numeric(spark, sf_dir):
    return A.describe_numeric(staged_train(spark, sf_dir), NUMERIC)


_DIST = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(count(DISTINCT {c}) AS BIGINT) AS nunique, "
    f"CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_unique_with_null FROM {TRAIN}"
    for c in FEATS)


@register("distinct_profile", S.with_() + _DIST)
def q_distinct_profile(spark, sf_dir):
    return A.distinct_profile(train(spark, sf_dir), FEATS)


@register("value_counts", S.with_() + f"SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS count FROM {TRAIN} GROUP BY ALL")
def q_value_counts(spark, sf_dir):
    return A.value_counts(train(spark, sf_dir), "o_orderpriority")


@register("class_balance", S.with_() + "SELECT source, yTarget, CAST(count(*) AS BIGINT) AS count, "
          "round(count(*) / sum(count(*)) OVER (PARTITION BY source), 6) + 0.0 AS share FROM r GROUP BY source, yTarget")
def q_class_balance(spark, sf_dir):
    return A.class_balance(roles(spark, sf_dir), "yTarget", ["source"])


CT_SQL = [S.edges_cte("ed", TRAIN, NUMERIC, P5), S.ct_numeric_cte("ctn", TRAIN, NUMERIC, "ed"),
          S.ct_categorical_cte("ctc", TRAIN, CATEGORICAL), "ct AS (SELECT * FROM ctn UNION ALL SELECT * FROM ctc)"]


def train_ct(spark, sf_dir):
    t = train(spark, sf_dir)
    edges = B.edges_dict(B.quantile_edges(t, NUMERIC, 5))
    return A.contingency(t, {f: cut(F.col(f), edges[f]) for f in NUMERIC}, CATEGORICAL, "y")


@register("contingency", S.with_(*CT_SQL) + "SELECT * FROM ct")
def q_contingency(spark, sf_dir):
    return train_ct(spark, sf_dir)


# ============================================================ B: binning
def _explode_edges(df, col="edges"):
    return df.select("feature", F.posexplode(col).alias("idx", "edge"))


@register("quantile_edges", S.with_(S.edges_cte("ed", TRAIN, NUMERIC, P5)) +
          "SELECT feature, CAST(i - 1 AS INTEGER) AS idx, e[i] AS edge FROM ed, range(1, 7) t(i) WHERE i <= len(e)")
def q_quantile_edges(spark, sf_dir):
    return _explode_edges(B.quantile_edges(train(spark, sf_dir), NUMERIC, 5))


@register("forced_edges", S.with_(forced_sql("fe", TRAIN, NUMERIC)) +
          "SELECT feature, CAST(i - 1 AS INTEGER) AS idx, e[i] AS edge FROM fe, range(1, 8) t(i) WHERE i <= len(e)")
def q_forced_edges(spark, sf_dir):
    return _explode_edges(B.forced_edges(train(spark, sf_dir), NUMERIC, 5))


@register("monotonic_edges")
def q_monotonic_edges(spark, sf_dir):
    return B.monotonic_edges(staged_train(spark, sf_dir), NUMERIC)


LOWC = NUMERIC + ["l_linenumber", "remainder"]
_LC = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_distinct "
    f"FROM (SELECT *, l_quantity % 4 AS remainder FROM r WHERE source = 'Train')" for c in LOWC)


@register("low_cardinality_levels", S.with_(f"lc AS ({_LC})") +
          f"SELECT lc.feature, n_distinct <= 5 AS low_cardinality, CASE WHEN n_distinct <= 5 THEN n_distinct END AS n_distinct, level FROM lc LEFT JOIN "
          f"(SELECT DISTINCT feature, level FROM {S.unpivot('(SELECT *, l_quantity % 4 AS remainder FROM r WHERE source = ' + chr(39) + 'Train' + chr(39) + ')', LOWC, [], value='level', cast='DOUBLE')} "
          "WHERE level IS NOT NULL) lv ON lv.feature = lc.feature AND n_distinct <= 5")
def q_low_cardinality_levels(spark, sf_dir):
    lv = B.low_cardinality_levels(train(spark, sf_dir).withColumn("remainder", F.col("l_quantity") % 4), LOWC, 5)
    return lv.select("feature", "low_cardinality", F.when(F.col("low_cardinality"), F.col("n_distinct")).alias("n_distinct"),
                     F.explode_outer(F.when(F.col("low_cardinality"), F.col("levels"))).alias("level"))


CUSTOM = {"l_quantity": [0.0, 10.0, 20.0, 30.0, 40.0, 50.0], "l_discount": [0.0, 0.02, 0.05, 0.1]}
_CUST = " UNION ALL ".join(f"SELECT '{f}' AS feature, {S.plist(e)} AS e" for f, e in CUSTOM.items())


@register("apply_custom_bins", S.with_(f"ce AS ({_CUST})", S.ct_numeric_cte("ctn", "r", list(CUSTOM), "ce", ["source"]))
          + "SELECT source, feature, bin, n FROM ctn")
def q_apply_custom_bins(spark, sf_dir):
    d = roles(spark, sf_dir)
    edges = B.edges_dict(B.custom_edges(spark, CUSTOM))
    b = B.apply_bins(d, edges)
    return A.contingency(b, list(CUSTOM), [], "y", ["source"]).select("source", "feature", "bin", "n")


EW = NUMERIC
TEST = "(SELECT * FROM r WHERE source = 'Test')"
_EW = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round_even(min({c}), 0) AS lo, round_even(max({c}), 0) AS hi FROM "
    f"(SELECT {c} FROM r WHERE source IN ('Train', 'Test'))" for c in EW)
EW_SQL = (f"mm AS ({_EW})",
          "ew AS (SELECT feature, CASE WHEN round_even((hi - lo) / 10, 0) > 0 THEN "
          "list_transform(range(CAST(lo AS BIGINT), CAST(hi AS BIGINT), CAST(round_even((hi - lo) / 10, 0) AS BIGINT)), "
          "lambda v: CAST(v AS DOUBLE)) ELSE [] END AS e FROM mm)")


@register("equal_width_bins", S.with_(*EW_SQL) +
          "SELECT feature, CAST(i - 1 AS INTEGER) AS idx, e[i] AS edge FROM ew, range(1, 100) t(i) WHERE i <= len(e)")
def q_equal_width_bins(spark, sf_dir):
    d = roles(spark, sf_dir)
    e = B.equal_width_edges(d.where(F.col("source") == "Train"), d.where(F.col("source") == "Test"), EW, 10)
    return _explode_edges(e)


DEC = NUMERIC
DEC_SQL = S.edges_cte("de", TRAIN, DEC, [i / 10 for i in range(1, 11)], distinct=False)


@register("decile_histogram", S.with_(DEC_SQL) +
          f"SELECT source, feature, bin, CAST(count(*) AS BIGINT) AS n FROM (SELECT u.source, u.feature, "
          f"{S.hist_sql('u.x', 'de.q')} AS bin "
          f"FROM {S.unpivot('(SELECT * FROM r WHERE source IN (' + chr(39) + 'Train' + chr(39) + ', ' + chr(39) + 'Test' + chr(39) + '))', DEC, ['source'], cast='DOUBLE')} u "
          "JOIN de ON u.feature = de.feature) WHERE bin IS NOT NULL GROUP BY source, feature, bin")
def q_decile_histogram(spark, sf_dir):
    d = roles(spark, sf_dir).where(F.col("source").isin("Train", "Test"))
    edges = {r["feature"]: r["edges"] for r in B.decile_edges(d.where(F.col("source") == "Train"), DEC).collect()}
    h = B.apply_hist(d, edges)
    return A.contingency(h, DEC, [], "y", ["source"]).select("source", "feature", "bin", "n")


SDE_SQL = ("sq AS (SELECT list_transform(quantile_cont(score, " + S.plist([round(i / 10, 1) for i in range(11)])
           + "), lambda v: round(v, 9)) AS q FROM r WHERE source = 'Train')",
           "sde AS (SELECT list_sort(list_distinct(list_transform(q, lambda v: CASE WHEN v = list_min(q) THEN 0.0 "
           "WHEN v = list_max(q) THEN 1.0 ELSE v END))) AS e FROM sq)")


@register("score_decile_edges", S.with_(*SDE_SQL) +
          "SELECT CAST(i - 1 AS INTEGER) AS idx, e[i] AS edge FROM sde, range(1, 12) t(i) WHERE i <= len(e)")
def q_score_decile_edges(spark, sf_dir):
    e = B.score_decile_edges(train(spark, sf_dir), "score", 10)
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(e)], "idx int, edge double")


RB_SQL = ("rq AS (SELECT list_sort(list_distinct(list_transform(quantile_cont(score, " + S.plist(P5)
          + "), lambda v: round(v, 9)))) AS e FROM r WHERE source = 'Train')",)


def train_band_edges(d):
    return B.risk_band_edges(d.where(F.col("source") == "Train"), "score", 5).first()["edges"]


@register("risk_band_edges", S.with_(*RB_SQL) +
          "SELECT CAST(i - 1 AS INTEGER) AS idx, e[i] AS edge FROM rq, range(1, 7) t(i) WHERE i <= len(e)")
def q_risk_band_edges(spark, sf_dir):
    e = B.risk_band_edges(train(spark, sf_dir), "score", 5)
    return e.select(F.posexplode("edges").alias("idx", "edge"))


BANDS_SQL = (RP, SC, *RB_SQL, f"bd AS (SELECT sc.*, {S.cut_sql('sc.score', 'rq.e', False)} AS risk_band FROM sc, rq)")


@register("risk_bands", S.with_(*BANDS_SQL) +
          "SELECT source, risk_band, CAST(count(*) AS BIGINT) AS n FROM bd GROUP BY ALL")
def q_risk_bands(spark, sf_dir):
    d = scored(spark, sf_dir)
    b = B.assign_risk_band(d, train_band_edges(d), "score")
    return b.groupBy("source", "risk_band").agg(F.count(F.lit(1)).alias("n"))


@register("bin_info", S.with_(forced_sql("fe", TRAIN, NUMERIC), S.ct_numeric_cte("ctn", TRAIN, NUMERIC, "fe")) +
          "SELECT c.feature, c.bin AS index, c.n AS count, fe.e[c.bin + 1] AS min FROM ctn c JOIN fe ON c.feature = fe.feature")
def q_bin_info(spark, sf_dir):
    t = train(spark, sf_dir)
    fe = B.forced_edges(t, NUMERIC, 5)
    edges = B.edges_dict(fe)
    ct = A.contingency(t, {f: cut(F.col(f), edges[f]) for f in NUMERIC}, [], "y")
    return B.bin_info(ct, fe)


# ============================================================ W: WOE / IV
@register("woe_table", S.with_(*CT_SQL, S.woe_cte("w", "ct")) +
          "SELECT feature, bin, level, n0, n1, " + ", ".join(
              f"{S.r6(c)} AS {c}" for c in ("pct0", "pct1", "woe")) + f", {S.r6('coalesce((pct0 - pct1) * woe, 0.0)')} AS iv FROM w")
def q_woe_table(spark, sf_dir):
    w = W.woe_table(train_ct(spark, sf_dir))
    return w.select("feature", "bin", "level", "n0", "n1", *[rnd(c, 6).alias(c) for c in ("pct0", "pct1", "woe", "iv")])


@register("iv_filter", S.with_(*CT_SQL, S.woe_cte("w", "ct")) +
          "SELECT feature, round(sum(coalesce((pct0 - pct1) * woe, 0.0)), 6) + 0.0 AS iv, "
          "sum(coalesce((pct0 - pct1) * woe, 0.0)) > 0.02 AS keep FROM w GROUP BY feature")
def q_iv_filter(spark, sf_dir):
    iv = W.feature_iv(train_ct(spark, sf_dir))
    return W.iv_filter(iv, 0.02).select("feature", rnd("iv", 6).alias("iv"), "keep")


_WE = ("we AS (SELECT feature, level, n, n1, n - n1 AS n0, sum(n1) OVER (PARTITION BY feature) AS tot1, "
       "sum(n - n1) OVER (PARTITION BY feature) AS tot0 FROM (SELECT feature, level, count(*) AS n, sum(y) AS n1 FROM "
       + S.unpivot("(SELECT y, " + ", ".join(f"coalesce({c}, 'missing') AS {c}" for c in CATEGORICAL) + f" FROM {TRAIN})",
                   CATEGORICAL, ["y"], value="level") + " GROUP BY ALL))")


_LV = ("lv AS (SELECT feature, level, CAST(count(*) AS BIGINT) AS rows FROM " + S.unpivot(
    "(SELECT " + ", ".join(f"coalesce({c}, 'missing') AS {c}" for c in CATEGORICAL) + " FROM r)", CATEGORICAL, [], value="level") + " GROUP BY ALL)")


@register("woe_encode", S.with_(_WE, _LV) +
          "SELECT feature, level, round(CASE WHEN n > 1 THEN ln(((n1 + 1.0) / (tot1 + 2.0)) / ((n0 + 1.0) / (tot0 + 2.0))) "
          "ELSE 0.0 END, 6) + 0.0 AS woe, lv.rows AS n FROM we JOIN lv USING (feature, level) "
          "UNION ALL SELECT feature, level, 0.0, rows FROM lv ANTI JOIN we USING (feature, level)")
def q_woe_encode(spark, sf_dir):
    """W4 fitted on the training rows and applied to every role: the code each level came out as, and its rows."""
    d = roles(spark, sf_dir)
    t = W.woe_encoder_table(d.where(F.col("source") == "Train"), CATEGORICAL, "y")
    both = d.select(*[F.coalesce(F.col(c), F.lit("missing")).alias(f"level_{c}") for c in CATEGORICAL], *CATEGORICAL)
    coded = W.woe_encode(both, t, CATEGORICAL)
    return (coded.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"level_{c}").alias("level"), F.col(c).alias("woe"))
                                            for c in CATEGORICAL]))).groupBy("feature", "level", "woe").agg(F.count("*").alias("n"))
            .select("feature", "level", rnd("woe", 6).alias("woe"), "n"))


@register("bin_performance", S.with_(*binned_scored_sql(), *PERF_SQL) + "SELECT * FROM perf")
def q_bin_performance(spark, sf_dir):
    return perf_frame(spark, sf_dir)


@register("bivariate_series", S.with_(*binned_scored_sql(), *PERF_SQL) +
          "SELECT source, feature, bin_no, CAST(bin_no AS VARCHAR) || '. ' || coalesce(level, CAST(bin AS VARCHAR)) AS bin_label, "
          "population_pct, bad_pct FROM (SELECT *, CAST(row_number() OVER (PARTITION BY source, feature "
          "ORDER BY bin NULLS FIRST, level NULLS FIRST) AS INTEGER) AS bin_no, round(Pop_Percent * 100, 2) + 0.0 AS population_pct, "
          "round(Bad_Percent * 100, 2) + 0.0 AS bad_pct FROM perf)")
def q_bivariate_series(spark, sf_dir):
    return W.bivariate_series(perf_frame(spark, sf_dir))


@register("iv_by_source", S.with_(*binned_scored_sql(), *PERF_SQL) +
          "SELECT feature, round(sum(IV) FILTER (WHERE source = 'Test'), 4) + 0.0 AS IV_Test, "
          "round(sum(IV) FILTER (WHERE source = 'OOT'), 4) + 0.0 AS IV_OOT, "
          "round(sum(IV) FILTER (WHERE source = 'PDV'), 4) + 0.0 AS IV_PDV FROM perf GROUP BY feature "
          "HAVING IV_Test IS NOT NULL AND IV_OOT IS NOT NULL AND IV_PDV IS NOT NULL")
def q_iv_by_source(spark, sf_dir):
    return W.iv_by_source(perf_frame(spark, sf_dir))


# ============================================================ C: association
def chi2_sf_duck(x: str, dof: str) -> str:
    """DuckDB text of the chi-square upper tail (same series / erfc fit as the Spark side)."""
    from ..functions.exprs import erfc_sql
    h = f"(({x}) / 2.0)"
    even = (f"exp(-{h}) * coalesce(list_sum(list_transform(range(0, CAST(({dof}) / 2 AS BIGINT)), "
            f"lambda j: exp(j * ln({h}) - lgamma(j + 1)))), 0.0)")
    odd = (f"{erfc_sql(f'sqrt({h})')} + exp(-{h}) * coalesce(list_sum(list_transform(range(1, CAST((({dof}) - 1) / 2 AS BIGINT) + 1), "
           f"lambda j: exp((j - 0.5) * ln({h}) - lgamma(j + 0.5)))), 0.0)")
    return (f"CASE WHEN ({dof}) <= 0 THEN 1.0 WHEN ({x}) <= 0 THEN 1.0 "
            f"WHEN ({dof}) % 2 = 0 THEN {even} ELSE {odd} END")


def chi_sql(src_ct: str, keys=()) -> list[str]:
    part = ", ".join([*keys, "feature"])
    kk = "".join(f"{k}, " for k in keys)
    return [
        f"c1 AS (SELECT *, sum(n) OVER (PARTITION BY {part}) AS _tot, sum(n0) OVER (PARTITION BY {part}) AS _c0, "
        f"sum(n1) OVER (PARTITION BY {part}) AS _c1, count(*) OVER (PARTITION BY {part}) AS _r FROM {src_ct})",
        "c2 AS (SELECT *, (CASE WHEN _c0 > 0 THEN 1 ELSE 0 END) + (CASE WHEN _c1 > 0 THEN 1 ELSE 0 END) AS _k FROM c1)",
        "c3 AS (SELECT *, (_r - 1) * (_k - 1) AS _dof, n * _c0 / _tot AS e0, n * _c1 / _tot AS e1 FROM c2)",
        "c4 AS (SELECT *, abs(n0 - e0) AS d0, abs(n1 - e1) AS d1 FROM c3)",
        "c5 AS (SELECT *, CASE WHEN _dof = 1 THEN d0 - least(0.5, d0) ELSE d0 END AS a0, "
        "CASE WHEN _dof = 1 THEN d1 - least(0.5, d1) ELSE d1 END AS a1 FROM c4)",
        f"chi AS (SELECT {kk}feature, CASE WHEN first(_dof) > 0 THEN sum(CASE WHEN e0 > 0 THEN a0 * a0 / e0 ELSE 0.0 END "
        f"+ CASE WHEN e1 > 0 THEN a1 * a1 / e1 ELSE 0.0 END) ELSE 0.0 END AS chi_square, "
        f"first(_dof) AS dof, first(_tot) AS n, first(_r) AS r, first(_k) AS k FROM c5 GROUP BY {part})",
        f"chip AS (SELECT *, {chi2_sf_duck('chi_square', 'dof')} AS p_value FROM chi)",
        "chiv AS (SELECT *, CASE WHEN n <= 1 THEN 0.0 WHEN least(k - (k - 1) * (k - 1) / (n - 1), r - (r - 1) * (r - 1) / (n - 1)) - 1 = 0 "
        "THEN 0.0 WHEN least(k - (k - 1) * (k - 1) / (n - 1), r - (r - 1) * (r - 1) / (n - 1)) - 1 > 0 THEN "
        "round(sqrt(greatest(0.0, chi_square / n - (k - 1) * (r - 1) / (n - 1)) / (least(k - (k - 1) * (k - 1) / (n - 1), "
        "r - (r - 1) * (r - 1) / (n - 1)) - 1)), 4) + 0.0 END AS cramers_v FROM chip)",
    ]


CT_CAT = [S.ct_categorical_cte("ctc", TRAIN, CATEGORICAL)]


def train_chi(spark, sf_dir):
    ct = A.contingency(train(spark, sf_dir), {}, CATEGORICAL, "y")
    return C.cramers_v(C.chi_square(ct))


@register("chi_square", S.with_(*CT_CAT, *chi_sql("ctc")) +
          "SELECT feature, round(chi_square, 6) + 0.0 AS chi_square, CAST(dof AS BIGINT) AS dof FROM chiv")
def q_chi_square(spark, sf_dir):
    return train_chi(spark, sf_dir).select("feature", rnd("chi_square", 6).alias("chi_square"),
                                           F.col("dof").cast("long").alias("dof"))


@register("chi_square_pvalue", S.with_(*CT_CAT, *chi_sql("ctc")) +
          "SELECT feature, round(p_value, 6) + 0.0 AS p_value FROM chiv")
def q_chi_square_pvalue(spark, sf_dir):
    return train_chi(spark, sf_dir).select("feature", rnd("p_value", 6).alias("p_value"))


@register("cramers_v", S.with_(*CT_CAT, *chi_sql("ctc")) + "SELECT feature, cramers_v FROM chiv")
def q_cramers_v(spark, sf_dir):
    return train_chi(spark, sf_dir).select("feature", "cramers_v")


_CARD2 = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) "
    f"AS n_unique_with_null FROM {TRAIN}" for c in CATEGORICAL)


@register("cramersv_filter", S.with_(*CT_CAT, *chi_sql("ctc"), f"cd AS ({_CARD2})") +
          "SELECT cd.feature, CASE WHEN n_unique_with_null > 15 THEN NULL ELSE cramers_v END AS cramers_v, "
          "n_unique_with_null, (n_unique_with_null > 15 OR cramers_v <= 0.1) AS eliminate "
          "FROM cd LEFT JOIN chiv ON cd.feature = chiv.feature")
def q_cramersv_filter(spark, sf_dir):
    t = train(spark, sf_dir)
    return C.cramersv_filter(train_chi(spark, sf_dir), A.distinct_profile(t, CATEGORICAL), 0.1, 15)


@register("cramersv_by_source", S.with_(
    *binned_scored_sql(),
    "cts AS (SELECT source, feature, bin, level, count(*) AS n, sum(pred) AS n1, count(*) - sum(pred) AS n0 FROM bs "
    "WHERE level IS NOT NULL AND source IN ('Test', 'OOT', 'PDV') GROUP BY ALL)", *chi_sql("cts", ["source"]))
    + "SELECT feature, " + ", ".join(
        f"max(CASE WHEN source = '{s}' THEN round(chi_square, 4) + 0.0 END) AS {s}_chi_square, "
        f"max(CASE WHEN source = '{s}' THEN round(p_value, 4) + 0.0 END) AS {s}_p_value, "
        f"max(CASE WHEN source = '{s}' THEN cramers_v END) AS {s}_cramers_v" for s in ("Test", "OOT", "PDV"))
    + " FROM chiv GROUP BY feature")
def q_cramersv_by_source(spark, sf_dir):
    b, _ = binned_scored(spark, sf_dir)
    ct = A.contingency(b.where(F.col("source").isin("Test", "OOT", "PDV")), {}, CATEGORICAL, "pred", ["source"])
    return C.cramersv_by_source(C.chi_square(ct, ["source"]))


_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS feature1, '{b}' AS feature2, "
    + ("max(1.0)" if a == b else f"corr({a}, {b})") + f" AS corr FROM {TRAIN}"
    for a in NUMERIC for b in NUMERIC)


@register("correlation_matrix", S.with_() + f"SELECT feature1, feature2, round(corr, 6) + 0.0 AS corr FROM ({_PAIRS})")
def q_correlation_matrix(spark, sf_dir):
    c = C.correlation_matrix(train(spark, sf_dir), NUMERIC)
    return c.select("feature1", "feature2", rnd("corr", 6).alias("corr"))


@register("correlated_pairs", S.with_(*CT_SQL, S.woe_cte("w", "ct"),
                                      "iv AS (SELECT feature, sum(coalesce((pct0 - pct1) * woe, 0.0)) AS iv FROM w GROUP BY feature)",
                                      f"cm AS ({_PAIRS})") +
          "SELECT DISTINCT CASE WHEN coalesce(i1.iv, 0.0) > coalesce(i2.iv, 0.0) THEN cm.feature2 ELSE cm.feature1 END AS feature "
          "FROM cm LEFT JOIN iv i1 ON cm.feature1 = i1.feature LEFT JOIN iv i2 ON cm.feature2 = i2.feature "
          "WHERE cm.feature1 <> cm.feature2 AND cm.corr > 0.5")
def q_correlated_pairs(spark, sf_dir):
    t = train(spark, sf_dir)
    return C.correlated_pairs(C.correlation_matrix(t, NUMERIC), W.feature_iv(train_ct(spark, sf_dir)), 0.5)


# inverse of the covariance matrix in SQL: one sweep per column, after which the matrix is minus its inverse
_K = len(NUMERIC)
_COV = "[" + ", ".join("[" + ", ".join(f"covar_samp({x}, {y})" for y in NUMERIC) + "]" for x in NUMERIC) + "]"
VIF_SQL = (
    f"whole AS (SELECT {', '.join(f'{c}::DOUBLE AS {c}' for c in NUMERIC)} FROM {TRAIN} WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in NUMERIC) + ")",
    f"mo AS (SELECT count(*) AS n, [{', '.join(f'avg({c})' for c in NUMERIC)}] AS m, {_COV} AS s FROM whole)",
    "sweep(p, a) AS (SELECT 1, s FROM mo UNION ALL SELECT p + 1, "
    f"list_transform(range(1, {_K + 1}), lambda i: list_transform(range(1, {_K + 1}), lambda j: "
    "CASE WHEN i = p AND j = p THEN -1.0 / a[p][p] WHEN i = p OR j = p THEN a[i][j] / a[p][p] ELSE a[i][j] - a[i][p] * a[p][j] / a[p][p] END)) "
    f"FROM sweep WHERE p <= {_K})",
    f"inv AS (SELECT a FROM sweep WHERE p = {_K + 1})",
    "vf AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, -a[{i}][{i}] * s[{i}][{i}] AS vif FROM inv, mo" for i, c in enumerate(NUMERIC, 1))
    + " UNION ALL SELECT 'const', 1.0 + n / (n - 1.0) * list_sum(list_transform("
    f"range(1, {_K + 1}), lambda i: list_sum(list_transform(range(1, {_K + 1}), lambda j: -m[i] * a[i][j] * m[j])))) FROM inv, mo)")


@register("vif", S.with_(*VIF_SQL) + "SELECT feature, round(vif, 6) + 0.0 AS vif FROM vf")
def q_vif(spark, sf_dir):
    return C.vif(train(spark, sf_dir), NUMERIC).select("feature", rnd("vif", 6).alias("vif"))


@register("vif_filter", S.with_(*VIF_SQL) + "SELECT feature, round(vif, 6) + 0.0 AS vif, vif >= 10 AS high_vif FROM vf")
def q_vif_filter(spark, sf_dir):
    v = C.vif_filter(C.vif(train(spark, sf_dir), NUMERIC), 10.0)
    return v.select("feature", rnd("vif", 6).alias("vif"), "high_vif")


# ============================================================ D: stability
def train_test(spark, sf_dir):
    d = roles(spark, sf_dir)
    return d.where(F.col("source") == "Train"), d.where(F.col("source") == "Test")


@register("psi_equal_width", S.with_(
    *EW_SQL,
    "bl AS (SELECT ew.feature, CAST(i AS INTEGER) AS bin FROM ew, range(0, 100) t(i) WHERE i < len(e) - 1)",
    "cnt AS (SELECT src, feature, bin, count(*) AS n FROM (SELECT CASE WHEN u.source = 'Train' THEN 'E' ELSE 'A' END AS src, "
    f"u.feature, {S.cut_sql('u.x', 'ew.e', False)} AS bin FROM "
    + S.unpivot("(SELECT * FROM r WHERE source IN ('Train', 'Test'))", EW, ["source"], cast="DOUBLE")
    + " u JOIN ew ON u.feature = ew.feature) WHERE bin IS NOT NULL GROUP BY ALL)",
    "sh AS (SELECT *, n / sum(n) OVER (PARTITION BY src, feature) AS share FROM cnt)",
    "j AS (SELECT bl.feature, coalesce(e.share, 0.0) AS e, coalesce(a.share, 0.0) AS a FROM bl "
    "LEFT JOIN sh e ON e.src = 'E' AND e.feature = bl.feature AND e.bin = bl.bin "
    "LEFT JOIN sh a ON a.src = 'A' AND a.feature = bl.feature AND a.bin = bl.bin)")
    + "SELECT feature, CASE WHEN sum(CASE WHEN e > 0 AND a > 0 THEN 0 ELSE 1 END) = 0 THEN "
      "round(sum(CASE WHEN e > 0 AND a > 0 THEN (e - a) * ln(e / a) END), 6) + 0.0 END AS psi, "
      "CAST(sum(CASE WHEN e > 0 AND a > 0 THEN 0 ELSE 1 END) AS BIGINT) AS n_nonfinite FROM j GROUP BY feature")
def q_psi_equal_width(spark, sf_dir):
    base, cur = train_test(spark, sf_dir)
    return D.psi_equal_width(base, cur, EW, 10)


def csi_sql(cnt_cte: str) -> list[str]:
    return [cnt_cte,
            "sh AS (SELECT *, n / sum(n) OVER (PARTITION BY source, feature) AS share FROM cnt)",
            "j AS (SELECT coalesce(e.feature, a.feature) AS feature, coalesce(e.share, 0.0) AS e, coalesce(a.share, 0.0) AS a "
            "FROM (SELECT * FROM sh WHERE source = 'Train') e FULL OUTER JOIN (SELECT * FROM sh WHERE source = 'Test') a "
            "ON e.feature = a.feature AND e.k = a.k)",
            "csi AS (SELECT feature, round(sum(CASE WHEN a > 0 AND e > 0 THEN (a - e) * ln(a / e) ELSE 0.0 END), 4) + 0.0 AS csi "
            "FROM j GROUP BY feature)"]


CSI_NUM_CNT = ("cnt AS (SELECT source, feature, CAST(bin AS VARCHAR) AS k, count(*) AS n FROM (SELECT u.source, u.feature, "
               f"{S.hist_sql('u.x', 'de.q')} AS bin FROM "
               + S.unpivot("(SELECT * FROM r WHERE source IN ('Train', 'Test'))", DEC, ["source"], cast="DOUBLE")
               + " u JOIN de ON u.feature = de.feature) WHERE bin IS NOT NULL GROUP BY ALL)")
CSI_CAT_CNT = ("cnt AS (SELECT source, feature, level AS k, count(*) AS n FROM "
               + S.unpivot("(SELECT * FROM r WHERE source IN ('Train', 'Test'))", CATEGORICAL, ["source"], value="level",
                           cast="VARCHAR") + " GROUP BY ALL)")


@register("csi_numeric", S.with_(DEC_SQL, *csi_sql(CSI_NUM_CNT)) + "SELECT * FROM csi")
def q_csi_numeric(spark, sf_dir):
    return D.csi_numeric(roles(spark, sf_dir), DEC)


@register("csi_categorical", S.with_(*csi_sql(CSI_CAT_CNT)) + "SELECT * FROM csi")
def q_csi_categorical(spark, sf_dir):
    return D.csi_categorical(roles(spark, sf_dir), CATEGORICAL)


_csi_cat2 = [c.replace("sh AS", "sh2 AS").replace("FROM cnt)", "FROM cnt2)").replace("cnt AS", "cnt2 AS")
             .replace("FROM sh WHERE", "FROM sh2 WHERE").replace("j AS", "j2 AS").replace("csi AS", "csi2 AS")
             .replace("FROM j GROUP", "FROM j2 GROUP") for c in csi_sql(CSI_CAT_CNT)]


@register("csi_report", S.with_(DEC_SQL, *csi_sql(CSI_NUM_CNT), *_csi_cat2) +
          "SELECT * FROM csi UNION ALL SELECT * FROM csi2")
def q_csi_report(spark, sf_dir):
    return D.csi_report(roles(spark, sf_dir), DEC, CATEGORICAL)


CSI_DETAIL_SQL = (
    "pk AS (SELECT source, feature, coalesce(CAST(bin AS VARCHAR), level) AS bin_key, Pop_Percent FROM perf)",
    "cd AS (SELECT feature, bin_key, max(Pop_Percent) FILTER (WHERE source = 'Test') AS Pop_Percent_Test, "
    "max(Pop_Percent) FILTER (WHERE source = 'OOT') AS Pop_Percent_OOT, "
    "max(Pop_Percent) FILTER (WHERE source = 'PDV') AS Pop_Percent_PDV FROM pk GROUP BY feature, bin_key)",
    "cdt AS (SELECT *, " + ", ".join(
        f"CASE WHEN Pop_Percent_Test IS NULL OR Pop_Percent_{s} IS NULL THEN NULL "
        f"WHEN Pop_Percent_Test > 0 AND Pop_Percent_{s} > 0 THEN round((Pop_Percent_Test - Pop_Percent_{s}) * "
        f"ln(Pop_Percent_Test / Pop_Percent_{s}), 4) + 0.0 WHEN Pop_Percent_Test = 0 AND Pop_Percent_{s} = 0 THEN NULL "
        f"ELSE 0.0 END AS PSI_test_{s.lower()}" for s in ("OOT", "PDV")) + " FROM cd)")


@register("csi_detail", S.with_(*binned_scored_sql(), *PERF_SQL, *CSI_DETAIL_SQL) + "SELECT * FROM cdt")
def q_csi_detail(spark, sf_dir):
    return D.csi_detail(perf_frame(spark, sf_dir))


@register("csi_summary", S.with_(*binned_scored_sql(), *PERF_SQL, *CSI_DETAIL_SQL) +
          "SELECT feature, round(sum(PSI_test_oot), 4) + 0.0 AS PSI_OOT, round(sum(PSI_test_pdv), 4) + 0.0 AS PSI_PDV "
          "FROM cdt WHERE feature IS NOT NULL GROUP BY feature")
def q_csi_summary(spark, sf_dir):
    return D.csi_summary(D.csi_detail(perf_frame(spark, sf_dir)))


BAND_TABLE_SQL = (
    "bt0 AS (SELECT source, risk_band, count(*) AS Count, CAST(sum(y) AS BIGINT) AS Goods FROM bd "
    "WHERE risk_band IS NOT NULL GROUP BY ALL)",
    "pop AS (SELECT source, count(*) AS _pop FROM bd GROUP BY source)",
    "nb AS (SELECT count(DISTINCT risk_band) AS nbase FROM bt0 WHERE source = 'Train')",
    "bt1 AS (SELECT bt0.*, Count - Goods AS Bads, Count / _pop AS Population, "
    "sum(Count - Goods) OVER (PARTITION BY bt0.source ORDER BY risk_band ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS Cum_Bads, "
    "CASE WHEN sum(Count - Goods) OVER (PARTITION BY bt0.source) <> 0 THEN (Count - Goods) / sum(Count - Goods) OVER (PARTITION BY bt0.source) END AS Cum_Bads_pct, "
    "row_number() OVER (PARTITION BY bt0.source ORDER BY risk_band) AS _i FROM bt0 JOIN pop ON bt0.source = pop.source)",
    "bt2 AS (SELECT *, round(sum(Cum_Bads_pct) OVER (PARTITION BY source ORDER BY risk_band ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 100.0, 4) + 0.0 AS Gain, "
    "_i * (100.0 / nbase) AS lift_per_band FROM bt1, nb)",
    "bt AS (SELECT b.source, b.risk_band, CAST(b.Count AS BIGINT) AS Count, b.Goods, CAST(b.Bads AS BIGINT) AS Bads, "
    "round(b.Population, 6) + 0.0 AS Population, CAST(b.Cum_Bads AS BIGINT) AS Cum_Bads, round(b.Cum_Bads_pct, 6) + 0.0 AS Cum_Bads_pct, "
    "b.Gain, round(b.lift_per_band, 6) + 0.0 AS lift_per_band, round(CASE WHEN b.lift_per_band <> 0 THEN b.Gain / b.lift_per_band END, 6) + 0.0 AS Lift, "
    "round(CASE WHEN t.Population > 0 AND b.Population > 0 THEN (t.Population - b.Population) * ln(t.Population / b.Population) ELSE 0.0 END, 6) + 0.0 AS PSI "
    "FROM bt2 b LEFT JOIN (SELECT risk_band, Population FROM bt2 WHERE source = 'Train') t ON b.risk_band = t.risk_band)")


def band_frame(spark, sf_dir):
    d = scored(spark, sf_dir)
    b = B.assign_risk_band(d, train_band_edges(d), "score")
    return D.band_table(b, "risk_band", "y")


@register("band_psi", S.with_(*BANDS_SQL, *BAND_TABLE_SQL) + "SELECT * FROM bt")
def q_band_psi(spark, sf_dir):
    return band_frame(spark, sf_dir)


@register("band_psi_total", S.with_(*BANDS_SQL, *BAND_TABLE_SQL) +
          "SELECT source, round(sum(PSI), 6) + 0.0 AS PSI FROM bt GROUP BY source")
def q_band_psi_total(spark, sf_dir):
    return D.band_psi_total(band_frame(spark, sf_dir))


# ============================================================ E: performance
CM_SQL = ("cm AS (SELECT source, " + ", ".join(
    f"CAST(sum(CASE WHEN CAST(y AS INTEGER) = {a} AND pred = {p} THEN 1 ELSE 0 END) AS BIGINT) AS {n}"
    for a, p, n in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))) + " FROM sc GROUP BY source)",
    "cma AS (SELECT *, (coalesce(CASE WHEN tp + fn <> 0 THEN tp / (tp + fn) END, 0.0) + "
    "coalesce(CASE WHEN tn + fp <> 0 THEN tn / (tn + fp) END, 0.0)) / 2 AS auc FROM cm)")


@register("confusion_matrix", S.with_(RP, SC, *CM_SQL) + "SELECT source, tn, fp, fn, tp FROM cm")
def q_confusion_matrix(spark, sf_dir):
    return E.confusion_matrix(scored(spark, sf_dir), "y", "pred", ["source"])


def _cr_sql() -> str:
    def cls(label, tp, fp, fn):
        prec = f"coalesce(CASE WHEN {tp} + {fp} <> 0 THEN {tp} / ({tp} + {fp}) END, 0.0)"
        rec = f"coalesce(CASE WHEN {tp} + {fn} <> 0 THEN {tp} / ({tp} + {fn}) END, 0.0)"
        f1 = f"coalesce(CASE WHEN ({prec}) + ({rec}) <> 0 THEN 2 * ({prec}) * ({rec}) / (({prec}) + ({rec})) END, 0.0)"
        return (f"SELECT source, '{label}' AS label, {prec} AS precision, {rec} AS recall, {f1} AS f1, "
                f"CAST({tp} + {fn} AS DOUBLE) AS support FROM cm")
    return f"per AS ({cls('0', 'tn', 'fn', 'fp')} UNION ALL {cls('1', 'tp', 'fp', 'fn')})"


@register("classification_report", S.with_(RP, SC, *CM_SQL, _cr_sql(),
    "allr AS (SELECT * FROM per UNION ALL "
    "SELECT source, 'accuracy', NULL, NULL, coalesce(CASE WHEN tn + fp + fn + tp <> 0 THEN (tn + tp) / (tn + fp + fn + tp) END, 0.0), "
    "CAST(tn + fp + fn + tp AS DOUBLE) FROM cm UNION ALL "
    "SELECT source, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per GROUP BY source UNION ALL "
    "SELECT source, 'weighted avg', coalesce(sum(precision * support) / nullif(sum(support), 0), 0.0), "
    "coalesce(sum(recall * support) / nullif(sum(support), 0), 0.0), coalesce(sum(f1 * support) / nullif(sum(support), 0), 0.0), "
    "sum(support) FROM per GROUP BY source)")
    + "SELECT source, label, round(precision, 6) + 0.0 AS precision, round(recall, 6) + 0.0 AS recall, "
      "round(f1, 6) + 0.0 AS f1, CAST(support AS BIGINT) AS support FROM allr")
def q_classification_report(spark, sf_dir):
    cm = E.confusion_matrix(scored(spark, sf_dir), "y", "pred", ["source"])
    return E.classification_report(cm, ["source"])


@register("auc_hard", S.with_(RP, SC, *CM_SQL) + "SELECT source, round(auc, 6) + 0.0 AS auc FROM cma")
def q_auc_hard(spark, sf_dir):
    cm = E.auc_hard(E.confusion_matrix(scored(spark, sf_dir), "y", "pred", ["source"]))
    return cm.select("source", rnd("auc", 6).alias("auc"))


KS_SQL = ("k0 AS (SELECT source, score, count(*) AS n, sum(y) AS t FROM sc GROUP BY ALL)",
          "k1 AS (SELECT *, sum(n) OVER w AS cn, sum(t) OVER w AS ct, sum(n) OVER (PARTITION BY source) AS tn, "
          "sum(t) OVER (PARTITION BY source) AS tt FROM k0 WINDOW w AS (PARTITION BY source ORDER BY score "
          "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))",
          "k2 AS (SELECT *, CASE WHEN tt <> 0 THEN ct / tt END AS cum_target_pct, "
          "CASE WHEN tn - tt <> 0 THEN (cn - ct) / (tn - tt) END AS cum_non_target_pct FROM k1)",
          "k3 AS (SELECT *, abs(cum_target_pct - cum_non_target_pct) AS ks FROM k2)")


@register("ks", S.with_(RP, SC, *KS_SQL) + "SELECT source, round(max(ks), 6) + 0.0 AS ks FROM k3 GROUP BY source")
def q_ks(spark, sf_dir):
    return E.ks(scored(spark, sf_dir), "score", "y", ["source"]).select("source", rnd("ks", 6).alias("ks"))


@register("ks_curve", S.with_(RP, SC, *KS_SQL) +
          "SELECT source, round(score, 6) + 0.0 AS score, CAST(cn AS BIGINT) AS cum_population, CAST(ct AS BIGINT) AS cum_target, "
          "CAST(cn - ct AS BIGINT) AS cum_non_target, round(cn / tn, 6) + 0.0 AS cum_population_pct, "
          "round(cum_target_pct, 6) + 0.0 AS cum_target_pct, round(cum_non_target_pct, 6) + 0.0 AS cum_non_target_pct, "
          "round(ks, 6) + 0.0 AS ks FROM k3")
def q_ks_curve(spark, sf_dir):
    c = E.ks_curve(scored(spark, sf_dir), "score", "y", ["source"])
    return c.select("source", rnd("score", 6).alias("score"), "cum_population", "cum_target", "cum_non_target",
                    *[rnd(x, 6).alias(x) for x in ("cum_population_pct", "cum_target_pct", "cum_non_target_pct", "ks")])


@register("ks_table", S.with_(*SDE_SQL,
    f"kb AS (SELECT {S.cut_sql('t.score', 'sde.e')} AS bin, CAST(CASE WHEN t.y = 0.0 THEN 1 ELSE 0 END AS BIGINT) AS tg "
    f"FROM {TRAIN} t, sde)",
    "kg AS (SELECT bin, sum(tg) AS TARGET, count(*) AS TOTAL FROM kb WHERE bin IS NOT NULL GROUP BY bin)",
    "kw AS (SELECT *, TOTAL - TARGET AS NONTARGET, sum(TARGET) OVER () AS _tt, sum(TOTAL - TARGET) OVER () AS _tn, "
    "sum(TOTAL) OVER () AS _n, sum(TARGET) OVER w AS Cumulative_Target, sum(TOTAL - TARGET) OVER w AS Cumulative_NonTarget, "
    "sum(TOTAL) OVER w AS Cumulative_Total FROM kg WINDOW w AS (ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))",
    "kx AS (SELECT kw.*, round(TOTAL / _n * 100, 2) + 0.0 AS pop, round(CASE WHEN _tt <> 0 THEN Cumulative_Target / _tt END * 100, 2) + 0.0 AS gain, "
    "round(CASE WHEN _tn <> 0 THEN Cumulative_NonTarget / _tn END * 100, 2) + 0.0 AS nont, sde.e FROM kw, sde)")
    + "SELECT bin AS DECILE, e[bin + 1] AS score_lo, e[bin + 2] AS score_hi, CAST(TARGET AS BIGINT) AS TARGET, "
      "CAST(NONTARGET AS BIGINT) AS NONTARGET, CAST(TOTAL AS BIGINT) AS TOTAL, pop AS Population_pct, "
      "round(CASE WHEN _tt <> 0 THEN TARGET / _tt END * 100, 2) + 0.0 AS BAD_CAPTURED, CAST(Cumulative_Target AS BIGINT) AS Cumulative_Target, "
      "CAST(Cumulative_NonTarget AS BIGINT) AS Cumulative_NonTarget, CAST(Cumulative_Total AS BIGINT) AS Cumulative_Total, "
      "gain AS Cumulative_Target_pct, nont AS Cumulative_NonTarget_pct, round(gain - nont, 2) + 0.0 AS KS, "
      "round(CASE WHEN pop <> 0 THEN gain / pop END, 6) + 0.0 AS CumulativeLift FROM kx")
def q_ks_table(spark, sf_dir):
    return E.ks_table(train(spark, sf_dir), "score", "y", bad=0.0, bins=10)


@register("gain_lift", S.with_(*BANDS_SQL, *BAND_TABLE_SQL) +
          "SELECT source, risk_band, Count, Goods, Bads, Cum_Bads, Cum_Bads_pct, Gain, lift_per_band, Lift FROM bt")
def q_gain_lift(spark, sf_dir):
    return band_frame(spark, sf_dir).select(
        "source", "risk_band", "Count", "Goods", "Bads", "Cum_Bads", "Cum_Bads_pct", "Gain", "lift_per_band", "Lift")


@register("accuracy_summary", S.with_(RP, SC, *CM_SQL, *KS_SQL) +
          "SELECT cma.source, round(auc, 5) + 0.0 AS auc, round(k.ks, 5) + 0.0 AS ks FROM cma JOIN "
          "(SELECT source, max(ks) AS ks FROM k3 GROUP BY source) k ON cma.source = k.source "
          "WHERE cma.source IN ('Test', 'OOT', 'PDV')")
def q_accuracy_summary(spark, sf_dir):
    return E.accuracy_summary(scored(spark, sf_dir), "score", "y", "pred")


@register("role_comparison", S.with_(RP, SC, *CM_SQL, _cr_sql()) +
          "SELECT source, tn, fp, fn, tp, round(auc, 4) + 0.0 AS auc, "
          "round(CASE WHEN tn + fp + fn + tp <> 0 THEN (tn + tp) / (tn + fp + fn + tp) END, 4) + 0.0 AS accuracy, "
          + ", ".join(f"max(round(p.precision, 6) + 0.0) FILTER (WHERE label = '{c}') AS precision_{c}, max(round(p.recall, 6) + 0.0) FILTER (WHERE label = '{c}') AS recall_{c}, "
                      f"max(round(p.f1, 6) + 0.0) FILTER (WHERE label = '{c}') AS f1_{c}, CAST(max(p.support) FILTER (WHERE label = '{c}') AS BIGINT) AS support_{c}" for c in "01")
          + " FROM cma JOIN per p USING (source) GROUP BY ALL")
def q_role_comparison(spark, sf_dir):
    return E.role_comparison(scored(spark, sf_dir), "y", "pred")


# ============================================================ M: modelling
from ..operators import distcheck as DC  # noqa: E402
from ..operators import model as M  # noqa: E402

RS = NUMERIC


@register("robust_scale", S.with_(
    f"rq AS (SELECT feature, quantile_cont(x, [0.25, 0.5, 0.75]) AS q FROM {S.unpivot(TRAIN, RS, [], cast='DOUBLE')} GROUP BY feature)",
    "rp2 AS (SELECT feature, q[2] AS med, CASE WHEN q[3] - q[1] <> 0 THEN q[3] - q[1] ELSE 1.0 END AS iqr FROM rq)")
    + "SELECT rp2.feature, round(med, 6) + 0.0 AS median, round(iqr, 6) + 0.0 AS iqr, "
      "round(avg((coalesce(u.x, med) - med) / iqr), 6) + 0.0 AS scaled_mean FROM rp2 JOIN "
      f"(UNPIVOT (SELECT {', '.join(f'coalesce({c}, -1e308) AS {c}' for c in RS)} FROM {TRAIN}) ON {', '.join(RS)} "
      "INTO NAME feature VALUE x0) v ON v.feature = rp2.feature, LATERAL (SELECT CASE WHEN v.x0 = -1e308 THEN NULL ELSE v.x0 END AS x) u "
      "GROUP BY rp2.feature, med, iqr")
def q_robust_scale(spark, sf_dir):
    t = train(spark, sf_dir)
    params = M.robust_scaler(t, RS)
    d = M.robust_scale(t, params)
    means = d.agg(*[F.avg(c).alias(c) for c in RS])
    return means.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("feature"), rnd(F.lit(params[c][0]), 6).alias("median"),
        rnd(F.lit(params[c][1]), 6).alias("iqr"), rnd(F.col(c), 6).alias("scaled_mean")) for c in RS])))


@register("ordinal_encode", S.with_() +
          "SELECT feature, level, CAST(dense_rank() OVER (PARTITION BY feature ORDER BY level) - 1 AS INTEGER) AS code, "
          "n FROM (SELECT feature, level, CAST(count(*) AS BIGINT) AS n FROM " + S.unpivot(
              "(SELECT " + ", ".join(f"coalesce({c}, 'missing') AS {c}" for c in CATEGORICAL) + f" FROM {TRAIN})",
              CATEGORICAL, [], value="level") + " GROUP BY feature, level)")
def q_ordinal_encode(spark, sf_dir):
    t = train(spark, sf_dir)
    table = M.ordinal_table(t, CATEGORICAL)
    rows = M.ordinal_encode(t, table, CATEGORICAL).select(*[F.col(c).cast("int").alias(c) for c in CATEGORICAL])
    n = rows.unpivot([], CATEGORICAL, "feature", "code").groupBy("feature", "code").agg(F.count("*").alias("n"))
    return n.join(table, ["feature", "code"]).select("feature", "level", "code", "n")


MNUM, MCAT = NUMERIC, CATEGORICAL


_SLOTS = " UNION ALL ".join(f"SELECT {i} AS place, '{c}' AS feature, coalesce({c}, 'missing') AS level, source FROM r" for i, c in enumerate(CATEGORICAL))


@register("one_hot", S.with_(f"lv AS ({_SLOTS})", "slots AS (SELECT feature, level, row_number() OVER (ORDER BY place, level) - 1 AS slot "
          "FROM (SELECT DISTINCT place, feature, level FROM lv WHERE source = 'Train'))") +
          "SELECT CAST(slot AS INTEGER) AS slot, feature || '_' || level AS name, CAST(count(*) AS BIGINT) AS n FROM slots JOIN lv USING (feature, level) GROUP BY ALL")
def q_one_hot(spark, sf_dir):
    """M4 fitted on the training rows; the slots and how many rows of all roles have a 1 in each."""
    d = P.impute_categorical(roles(spark, sf_dir), MCAT)
    pm = Pipeline(stages=M.one_hot_stages(MCAT, "features")).fit(d.where(F.col("source") == "Train"))
    sums = pm.transform(d).select(Summarizer.sum(F.col("features")).alias("s")).select(F.posexplode(vector_to_array("s")).alias("slot", "n"))
    names = spark.createDataFrame(list(enumerate(M.one_hot_names(pm, MCAT))), "slot int, name string")
    return sums.join(names, "slot").select("slot", "name", F.col("n").cast("long").alias("n"))


def _card(rows, **kw):
    """The scorecard of the training rows of staged roles."""
    return M.build_scorecard(rows.where(F.col("source") == "Train"), MNUM, MCAT, "y", alpha=0.8, bins=5, **kw)


@register("logit_l1")
def q_logit_l1(spark, sf_dir):
    card = _card(staged_roles(spark, sf_dir))
    return M.coefficient_table(spark, M.lr_stage(card), card.names)


@register("coefficient_table")
def q_coefficient_table(spark, sf_dir):
    card = _card(staged_roles(spark, sf_dir))
    return M.coefficient_table(spark, M.lr_stage(card), card.names).where(F.col("coefficient") != 0)


@register("score")
def q_score(spark, sf_dir):
    d = staged_roles(spark, sf_dir)
    card = _card(d)
    s = M.apply_scorecard(d, card)
    return s.select("l_orderkey", "l_linenumber", "source", rnd("p", 6).alias("p"), "pred", "risk_band")


@register("first_model")
def q_first_model(spark, sf_dir):
    d = staged_roles(spark, sf_dir, pdv=True)
    card = _card(d)
    s = M.apply_scorecard(d, card)
    cm = E.auc_hard(E.confusion_matrix(s, "y", "pred", ["source"]))
    bands = s.groupBy("source").agg(F.count("risk_band").alias("banded"), F.count(F.lit(1)).alias("rows"))
    return cm.join(bands, "source").select("source", "tn", "fp", "fn", "tp", rnd("auc", 4).alias("auc"), "banded", "rows")


@register("inference_table")
def q_inference_table(spark, sf_dir):
    d = staged_roles(spark, sf_dir)
    card = _card(d)
    s = M.score(card.pipeline, d.where(F.col("source") == "Train"))
    return M.inference_table(spark, s, M.lr_stage(card), card.names)


REFINE_EDGES = {"l_quantity": [0.0, 10.0, 25.0, 40.0, 50.0]}
REFINE_BANDS = [0.0, 0.15, 0.3, 0.45, 0.6, 0.8, 1.0]


@register("refined_model")
def q_refined_model(spark, sf_dir):
    d = staged_roles(spark, sf_dir)
    card = _card(d, custom_edges=REFINE_EDGES, groups={"p_type": GROUPS},
                 transforms={"l_tax": "sqrt"}, bands=REFINE_BANDS)
    s = M.apply_scorecard(d, card)
    return s.groupBy("source", "risk_band").agg(F.count(F.lit(1)).alias("n"))


@register("logit_l2")
def q_logit_l2(spark, sf_dir):
    t = staged_train(spark, sf_dir)
    v, feats = M.selection_frame(t, MNUM, MCAT)
    try:
        m = M.logistic("l2", C=0.1, n_rows=v.count()).fit(v)
        return M.coefficient_table(spark, m, feats)
    finally:
        v.unpersist()


@register("woe_model")
def q_woe_model(spark, sf_dir):
    m, cols, _, _ = M.build_woe_model(staged_train(spark, sf_dir), MNUM, MCAT)
    return M.coefficient_table(spark, m, cols)


def _select_q(kind):
    def q(spark, sf_dir):
        t = staged_train(spark, sf_dir)
        v, feats = M.selection_frame(t, NUMERIC, CATEGORICAL, held=kind == "l1")
        try:
            n = M.default_n_features(len(feats))
            if kind == "rfe":
                out = [(f, None) for f in M.rfe(v, feats, n)]
            elif kind == "l1":
                out = M.l1_select(v, feats, n)
            else:
                out = [(f, None) for f in M.sequential_select(v, feats, n, kind)]
        finally:
            v.unpersist()
        return spark.createDataFrame(out, "feature string, coefficient double")
    return q


register("rfe")(_select_q("rfe"))
register("l1_select")(_select_q("l1"))
register("forward_select")(_select_q("forward"))
register("backward_select")(_select_q("backward"))


@register("tune")
def q_tune(spark, sf_dir):
    """20 random (penalty, C) scored by mean ROC AUC over 5 folds."""
    v, _ = M.selection_frame(staged_train(spark, sf_dir), NUMERIC, CATEGORICAL, held=False)
    try:
        rows = M.random_search(v)
    finally:
        v.unpersist()
    return spark.createDataFrame(rows, "penalty string, C double, auc double")


def _dc_q(method):
    def q(spark, sf_dir):
        d = staged_roles(spark, sf_dir, narrow=False)
        return DC.distribution_check(d.where(F.col("source") == "Train"), d.where(F.col("source") == "OOT"),
                                     NUMERIC, CATEGORICAL, method, svd_k=len(FEATS))
    return q


register("distribution_check_nb")(_dc_q("GaussianNB"))
register("distribution_check_lda")(_dc_q("LinearDiscriminantAnalysis"))
register("distribution_check_qda")(_dc_q("QuadraticDiscriminantAnalysis"))
register("distribution_check_knn")(_dc_q("KNeighborsClassifier"))

from pyspark.ml import Pipeline  # noqa: E402
from pyspark.ml.functions import vector_to_array  # noqa: E402
from pyspark.ml.stat import Summarizer  # noqa: E402


# ============================================================ S / F: sources, sinks, flows
from ..config import ScorecardConfig  # noqa: E402
from ..plans import flows as FL  # noqa: E402
from ..sources import io as IO  # noqa: E402

FLOW_CFG = ScorecardConfig(target="loan_status", bad_values=BAD_VALUES,
                           exclude=("l_orderkey", "l_linenumber", "l_shipdate", "yTarget", "y", "score"))


@register("save_stage", S.with_() + "SELECT source, CAST(count(*) AS BIGINT) AS n FROM r GROUP BY source")
def q_save_stage(spark, sf_dir):
    """The role-tagged loan view written to the shared checkpoint folder and read back."""
    back = IO.save_stage(roles(spark, sf_dir).select("source", *FEATS, "loan_status"), "loans_roles")
    return back.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@register("prepare_data", S.with_("d AS (SELECT DISTINCT * EXCLUDE (l_orderkey, l_linenumber, l_shipdate, y, score) FROM r)") +
          "SELECT source, yTarget, CAST(count(*) AS BIGINT) AS n FROM d GROUP BY source, yTarget")
def q_prepare_data(spark, sf_dir):
    """prepared rows (exclusions, dedup, target, drops, imputation) as a stage table."""
    st = FL.prepare_data(roles(spark, sf_dir), FLOW_CFG)
    return st.data.groupBy("source", "yTarget").agg(F.count(F.lit(1)).alias("n"))


@register("reduce_variables")
def q_reduce_variables(spark, sf_dir):
    """the IV table after the IV / Cramér's V / VIF screens, with the kept flag."""
    st = FL.prepare_data(roles(spark, sf_dir), FLOW_CFG)
    red = FL.reduce_variables(st, FLOW_CFG)
    kept = set(red.numeric) | set(red.categorical)
    return red.reports["iv"].withColumn("kept", F.col("feature").isin(*kept) if kept else F.lit(False))


@register("feature_selection")
def q_feature_selection(spark, sf_dir):
    """the features that stay after preparation, screens and the model-based choice."""
    st = FL.feature_selection(FL.reduce_variables(FL.prepare_data(staged_roles(spark, sf_dir), FLOW_CFG), FLOW_CFG), FLOW_CFG)
    return spark.createDataFrame([(f, "numeric") for f in st.numeric] + [(f, "categorical") for f in st.categorical],
                                 "feature string, kind string")


@register("execute")
def q_execute(spark, sf_dir):
    """F7 over all roles: F1-F4, the confusion matrix and accuracy per role of the scored rows."""
    return FL.execute(staged_roles(spark, sf_dir, pdv=True), FLOW_CFG).reports["role_comparison"]


@register("fine_tuning")
def q_fine_tuning(spark, sf_dir):
    """the refined scorecard's risk bands per role, with counts and PSI."""
    cfg = FLOW_CFG.with_(custom_edges=REFINE_EDGES, transforms={"l_tax": "sqrt"}, band_cuts=tuple(REFINE_BANDS))
    return FL.execute(staged_roles(spark, sf_dir, pdv=True), cfg, select=False, refine=True).reports["band_psi"]
