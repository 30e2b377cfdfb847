"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.session import scratch_path

# The white space that separates words in every contract: space and \t \n \v \f \r.
BLANKS = " \t\n\v\f\r"

# Texts handled together inside a task hold at most this many bytes (a single longer text is a slice of its own).
SLICE_BYTES = 4_000_000


def documents(spark: SparkSession, folder: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def frozen(df: DataFrame, name: str, **options) -> DataFrame:
    """Write `df` to the shared folder and read it back, so later steps neither recompute it nor lose it."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    """The text, a missing one as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, although `use` may need it in every step of a lambda."""
    return F.get(F.transform(F.array(value), use), 0)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that `df` does not use yet."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch whose texts together hold at most `limit` bytes, or a single row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for row, size in enumerate(sizes):
        if row > start and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch, missing ones as empty texts."""
    return [text or "" for text in batch.column(column).to_pylist()]
