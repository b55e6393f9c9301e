"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorecraft.session import ensure_checkpoint_dir

# ASCII white space of the contracts: space and \x09-\x0D (fixed value)
ASCII_SPACE = b" \t\n\x0b\x0c\r"
# A null doc_id stands below every other id.
NULL_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def new_stage(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder, never reused."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage and
    survives lost executors."""
    path = new_stage(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_or_lowest(col: str = "doc_id") -> Column:
    return F.coalesce(F.col(col).cast("long"), F.lit(NULL_ID))


def keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The columns the operators work on, under names of their own: ``_id`` (a
    null id is the lowest long), ``_th`` (hash of the text, tells rows that
    repeat an id apart) and ``_text`` (binary UTF-8, null is empty). Whatever
    other columns the input has are pruned here, so names cannot clash."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(id_or_lowest(doc_id).alias("_id"), F.xxhash64(body).alias("_th"),
                       body.cast("binary").alias("_text"))


def original_id(col: str = "_id") -> Column:
    return F.when(F.col(col) != NULL_ID, F.col(col))


ARROW = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(),
         "boolean": pa.bool_()}


def arrow_schema(columns: str) -> pa.Schema:
    """Arrow form of ``name type, name type[], ...``; usable inside a task."""
    fields = []
    for part in columns.split(","):
        name, kind = part.split()
        inner = ARROW[kind.removesuffix("[]")]
        fields.append(pa.field(name, pa.list_(inner) if kind.endswith("[]") else inner))
    return pa.schema(fields)


def ddl(columns: str) -> str:
    return ", ".join(f"{n} array<{k[:-2]}>" if k.endswith("[]") else f"{n} {k}"
                     for n, k in (part.split() for part in columns.split(",")))


def record_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_array(columns[f.name], f.type) for f in schema], schema=schema)


def arrow_stream(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[dict]], columns: str) -> DataFrame:
    """``mapInArrow`` of a function of all batches of a partition that yields dicts of columns."""
    schema = arrow_schema(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for out in fn(batches):
            batch = record_batch(out, schema)
            if batch.num_rows:
                yield batch

    return df.mapInArrow(run, ddl(columns))


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], columns: str) -> DataFrame:
    """``mapInArrow`` of a function of one batch that returns a dict of columns."""
    return arrow_stream(df, lambda batches: (fn(b) for b in batches if b.num_rows), columns)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def bounded_batches(batches: Iterator[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``most`` bytes of ``column`` (one row may be longer),
    so that memory per step does not follow the rows a batch happens to hold."""
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(column)).to_pylist()
        start = total = 0
        for i, n in enumerate(lengths):
            n = n or 0
            if i > start and total + n > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)


def carried(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns named c0, c1, ... by position, so that no name of theirs can
    clash with one of ours, beside ``_id`` and ``_th`` as ``keyed`` makes them."""
    named = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.toDF(*named.values())
    return rows.withColumns({"_id": id_or_lowest(named["doc_id"]),
                             "_th": F.xxhash64(F.coalesce(F.col(named["text"]).cast("string"), F.lit("")))})


def one_of_equals(rows: DataFrame) -> DataFrame:
    """One row of ``carried`` for each (id, text): of rows that differ in other columns the one
    of the least hash, so that reruns agree."""
    own = [c for c in rows.columns if c not in ("_id", "_th")]
    return (rows.groupBy("_id", "_th").agg(F.min_by(F.struct(*own), F.xxhash64(*own)).alias("r"))
            .select("r.*", "_id", "_th"))


def arrow_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema, most: int = 2 << 20,
               text: str = "text") -> DataFrame:
    """``mapInArrow`` of a function of one batch that keeps whole rows; ``schema`` is
    Spark's. A batch holds at most ``most`` bytes of ``text``, or one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in bounded_batches(batches, text, most):
            if b.num_rows and (out := fn(b)).num_rows:
                yield out

    return df.mapInArrow(run, schema)


def set_column(batch: pa.RecordBatch, name: str, values) -> pa.RecordBatch:
    at = batch.schema.get_field_index(name)
    return batch.set_column(at, batch.schema.field(at), pa.array(values, batch.schema.field(at).type))
