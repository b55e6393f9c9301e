"""Sources and sinks.

Reads are plain ``spark.read`` scans (column pruning and filter pushdown
reach the files); writes go to a shared folder as parquet tables. Stage
tables double as lineage cuts: a job that reads a written stage does not
recompute its inputs after an executor loss.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import release, stage_dir

# pandas' default missing-value spellings read as NULL (fixed values)
NA_VALUES = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _nan_to_null(df: DataFrame) -> DataFrame:
    return df.select(*[F.when(~F.isnan(F.col(f.name)), F.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else F.col(f.name)
                       for f in df.schema.fields])


# numbers as pandas reads them (Spark's own cast also takes type suffixes)
INTEGER, DECIMAL = r"^[+-]?\d{1,18}$", r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def infer_types(df: DataFrame) -> DataFrame:
    """String columns whose present values are all whole numbers become long, all numbers
    double; one aggregate decides for all columns. A column without values stays a string."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not cols:
        return df
    ref = {c: F.trim(F.col(f"`{c}`")) for c in cols}
    row = df.agg(*[F.array(F.count(ref[c]), F.count_if(ref[c].rlike(INTEGER)), F.count_if(ref[c].rlike(DECIMAL))).alias(f"c{i}")
                   for i, c in enumerate(cols)]).first()
    kinds = {c: "long" if row[i][0] == row[i][1] > 0 else "double" if row[i][0] == row[i][2] > 0 else None
             for i, c in enumerate(cols)}
    return df.withColumns({c: ref[c].cast(k) for c, k in kinds.items() if k})


def read_dataset(spark: SparkSession, path: str, role: str | None = None, fmt: str | None = None,
                 schema: T.StructType | str | None = None, line_sep: str | None = None) -> DataFrame:
    """CSV (header, inferred or given schema) or parquet; NA spellings and NaN -> NULL; ``source`` added.

    Without a schema, types are decided after the NA spellings are nulled, so
    that a numeric column which holds ``NA`` stays numeric.
    """
    fmt = fmt or ("parquet" if path.endswith(".parquet") else "csv")
    if fmt == "csv":
        r = spark.read.option("header", True).option("mode", "PERMISSIVE")
        r = r.schema(schema) if schema is not None else r.option("inferSchema", False)
        if line_sep:
            r = r.option("lineSep", line_sep)
        df = r.csv(path)
        df = df.select(*[F.when(~F.col(f.name).isin(*NA_VALUES), F.col(f.name)).alias(f.name)
                         if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema.fields])
        if schema is None:
            df = infer_types(df)
    else:
        df = spark.read.format(fmt).load(path)
    df = _nan_to_null(df)
    return df.withColumn("source", F.lit(role)) if role else df


def load_roles(spark: SparkSession, train: str, test: str | None = None, pdv: str | None = None,
               oot: str | None = None, **kw) -> DataFrame:
    """Union of the role files with a ``source`` column (missing columns -> NULL)."""
    out = read_dataset(spark, train, "Train", **kw)
    for path, role in ((test, "Test"), (pdv, "PDV"), (oot, "OOT")):
        if path:
            out = out.unionByName(read_dataset(spark, path, role, **kw), allowMissingColumns=True)
    return out


def write_cleansed(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """S3: prepared rows, one folder per role."""
    df.write.mode("overwrite").partitionBy("source").format(fmt).save(path)


def write_scored(df: DataFrame, path: str) -> None:
    """Binned variables + predicted label, partitioned by role."""
    df.write.mode("overwrite").partitionBy("source").parquet(path)


def write_report_table(df: DataFrame, base: str, name: str) -> str:
    """One named report table as parquet."""
    path = f"{base.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_metrics(spark: SparkSession, metrics: Mapping[str, float], path: str) -> None:
    """The AUC / KS dictionary as one JSON row."""
    spark.createDataFrame([(json.dumps(dict(metrics)),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)


def new_run() -> str:
    """A name for the stage tables of one run."""
    return f"run-{uuid.uuid4().hex}"


def _stage_path(spark: SparkSession, name: str, base: str | None, run: str) -> str:
    return f"{base.rstrip('/')}/{run}/{name}" if base else stage_dir(spark, f"{run}/{name}")


def save_stage(df: DataFrame, name: str, base: str | None = None, run: str | None = None) -> DataFrame:
    """Write a stage table to the shared checkpoint folder and read it back
    (cuts lineage; survives executor loss). Returns the re-read DataFrame.

    Every run (``new_run``; a fresh one if not given) has a folder of its own, and
    a stage is written once in it: no table is replaced under a frame that reads it.
    """
    path = _stage_path(df.sparkSession, name, base, run or new_run())
    df.write.mode("errorifexists").parquet(path)
    release(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_stage(spark: SparkSession, name: str, run: str, base: str | None = None) -> DataFrame:
    """Read a stage that :func:`save_stage` wrote under ``run``."""
    return spark.read.parquet(_stage_path(spark, name, base, run))


def save_model(card, path: str) -> None:
    """The fitted pipeline, binning included, and what reports read beside it."""
    card.pipeline.write().overwrite().save(f"{path}/pipeline")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps({"names": card.names, "band_edges": card.band_edges}),)],
                          "value string").write.mode("overwrite").text(f"{path}/meta")


def load_model(spark: SparkSession, path: str):
    """Inverse of :func:`save_model`."""
    from pyspark.ml import PipelineModel

    from ..operators.model import Scorecard
    meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
    return Scorecard(PipelineModel.load(f"{path}/pipeline"), meta["names"], meta["band_edges"])
