"""Shared pieces of the training-data operators: readers, Arrow maps, word counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import components
from ..scratch import drop, written

__all__ = ["arrow_map", "bounded", "components", "drop", "only", "small_batches", "table", "utf8", "words", "written"]

#: Rows of an Arrow batch. Documents can be long, so a batch of texts stays small.
ARROW_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ARROW_ROWS rows, so that a Python worker holds few long texts at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) != ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, object]], schema: str) -> DataFrame:
    """df through fn batch by batch; fn returns a column (list, numpy or Arrow array) for each field of schema."""
    spark = df.sparkSession
    small_batches(spark)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = fn(b)
            yield pa.RecordBatch.from_arrays([_as(cols[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def _as(values: object, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, type=kind)


def utf8(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a string column; null becomes empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def only(df: DataFrame, **kinds: str) -> DataFrame:
    """Just these columns, in these types: extra columns of the input, whatever their names, play no part."""
    return df.select(*[F.col(f"`{c}`").cast(k).alias(c) for c, k in kinds.items()])


#: Rows of a few numbers or digests that a join may broadcast (some 60 MB); beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """df, of so many narrow rows, marked for broadcast if that is few enough."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def words(c) -> F.Column:
    """Number of words [^\\x20\\x09-\\x0D]+ of a text (null: 0)."""
    return F.coalesce(F.regexp_count(c, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")

