"""The loan-shaped view over the driver's TPC-H-like tables (FIXTURES.md B).

The reference runs on loan CSVs that are not shipped; this view gives the
same shape (numeric and categorical features, NULLs, a status column with
"bad" values, a time split for out-of-time data) from tables whose size
grows with the scale factor, so every operator's work grows with them too.

The four big-table joins are plain equi-joins: Catalyst picks sort-merge for
lineitem x orders and lets AQE broadcast part/customer only when their
runtime size is under the broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BAD_LABEL, GOOD_LABEL
from .io import save_stage

# Fixed values of the fixture (FIXTURES.md B).
NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax",
           "o_totalprice", "p_size", "disc_amt"]
CATEGORICAL = ["l_linestatus", "o_orderpriority", "p_type", "c_mktsegment", "p_brand"]
EXCLUDED = ["l_orderkey", "l_linenumber", "l_shipdate"]
BAD_VALUES = ("Charged Off", "Default")
OOT_FROM = "2000-02-13"

LOANS_SQL = """
SELECT l_orderkey, l_linenumber, l_shipdate,
  l_quantity, l_extendedprice, l_discount,
  CASE WHEN l_orderkey % 10 = 3 THEN NULL ELSE l_tax END AS l_tax,
  CASE WHEN l_orderkey % 10 < 7 THEN NULL ELSE o_totalprice END AS o_totalprice,
  CAST(p_size AS DOUBLE) AS p_size,
  l_extendedprice * l_discount AS disc_amt,
  l_linestatus,
  CASE WHEN l_orderkey % 20 = 5 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
  p_type, c_mktsegment, p_brand,
  CASE WHEN l_quantity*2 + l_discount*400
          + (CASE WHEN p_type = 'PROMO' THEN 25 ELSE 0 END)
          + ((l_orderkey*7 + l_linenumber*13) % 60) > 130
       THEN CASE WHEN l_orderkey % 3 = 0 THEN 'Default' ELSE 'Charged Off' END
       WHEN l_linestatus = 'O' THEN 'Current' ELSE 'Fully Paid' END AS loan_status
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
     JOIN part ON l_partkey = p_partkey
     JOIN customer ON o_custkey = c_custkey
"""

# role / target / deterministic score, as SQL over `loans` (shared with the oracle)
ROLES_SQL = f"""
SELECT *,
  CASE WHEN l_shipdate >= TIMESTAMP '{OOT_FROM}' THEN 'OOT'
       WHEN l_orderkey % 4 = 0 THEN 'Test' ELSE 'Train' END AS source,
  CASE WHEN loan_status IN ('Charged Off', 'Default') THEN '{GOOD_LABEL}' ELSE '{BAD_LABEL}' END AS yTarget,
  CASE WHEN loan_status IN ('Charged Off', 'Default') THEN 0.0 ELSE 1.0 END AS y,
  LEAST(GREATEST((l_quantity*2 + l_discount*400) / 200.0, 0.0), 1.0) AS score
FROM loans
"""


def read_tables(spark: SparkSession, sf_dir: str, names=("lineitem", "orders", "part", "customer")) -> dict:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def loans(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """The raw loan view: features, exclusions and the status column. ``spread`` deals the
    rows out by their key, before any column is derived."""
    t = read_tables(spark, sf_dir)
    li = t["lineitem"].select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", "l_quantity",
                              "l_extendedprice", "l_discount", "l_tax", "l_linestatus")
    o = t["orders"].select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    p = t["part"].select("p_partkey", "p_type", "p_size", "p_brand")
    c = t["customer"].select("c_custkey", "c_mktsegment")
    # orders meet their customers first: the long table is moved for two joins, not for three
    j = li.join(o.join(c, o.o_custkey == c.c_custkey), li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    if spread:
        j = j.select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus",
                     "o_totalprice", "o_orderpriority", "p_type", "p_size", "p_brand", "c_mktsegment").repartition("l_orderkey", "l_linenumber")
    k = F.col("l_orderkey")
    bad = ((F.col("l_quantity") * 2 + F.col("l_discount") * 400
            + F.when(F.col("p_type") == "PROMO", 25).otherwise(0)
            + ((k * 7 + F.col("l_linenumber") * 13) % 60)) > 130)
    return j.select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount",
        F.when(k % 10 == 3, F.lit(None)).otherwise(F.col("l_tax")).alias("l_tax"),
        F.when(k % 10 < 7, F.lit(None)).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.col("p_size").cast("double").alias("p_size"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("disc_amt"),
        "l_linestatus",
        F.when(k % 20 == 5, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        "p_type", "c_mktsegment", "p_brand",
        F.when(bad, F.when(k % 3 == 0, "Default").otherwise("Charged Off"))
         .when(F.col("l_linestatus") == "O", "Current").otherwise("Fully Paid").alias("loan_status"))


def source_col() -> "F.Column":
    return (F.when(F.col("l_shipdate") >= F.lit(OOT_FROM).cast("timestamp_ntz"), "OOT")
            .when(F.col("l_orderkey") % 4 == 0, "Test").otherwise("Train"))


def with_roles(df: DataFrame) -> DataFrame:
    """Add source, yTarget (Level0 = bad status), y (0/1) and the fixed score."""
    is_bad = F.col("loan_status").isin(*BAD_VALUES)
    return df.select(
        "*", source_col().alias("source"),
        F.when(is_bad, GOOD_LABEL).otherwise(BAD_LABEL).alias("yTarget"),
        F.when(is_bad, 0.0).otherwise(1.0).alias("y"),
        F.least(F.greatest((F.col("l_quantity") * 2 + F.col("l_discount") * 400) / 200.0,
                           F.lit(0.0)), F.lit(1.0)).alias("score"))


def loans_roles(spark: SparkSession, sf_dir: str, pdv: bool = False) -> DataFrame:
    """loans with roles; ``pdv=True`` appends PDV = Test rows with l_linenumber <= 2."""
    df = with_roles(loans(spark, sf_dir))
    return with_pdv(df) if pdv else df


def with_pdv(df: DataFrame) -> DataFrame:
    return df.unionByName(df.where((F.col("source") == "Test") & (F.col("l_linenumber") <= 2))
                          .withColumn("source", F.lit("PDV")))


def staged_roles(spark: SparkSession, sf_dir: str, pdv: bool = False, narrow: bool = True) -> DataFrame:
    """``loans_roles`` as a stage table: the joins run once and every pass of a fit reads
    columns. Rows are spread by their key, so the passes are as wide as the cluster
    whatever the files' row groups and the joins' keys: before columns are derived, or
    (not ``narrow``) with them, for the checks whose keys hash sums that hang on the order of rows."""
    rows = with_roles(loans(spark, sf_dir, spread=True)) if narrow else loans_roles(spark, sf_dir).repartition("l_orderkey", "l_linenumber")
    staged = save_stage(rows, "staged_roles")
    return with_pdv(staged) if pdv else staged


def label_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second binary-target fixture: documents joined to labels (quality 0/1)."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", "lang", "source", "n_chars")
    lab = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return d.join(lab, "doc_id").withColumnRenamed("source", "doc_source")
