"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import checkpoint_dir


def ship_by_value(module_name: str) -> None:
    """Send a module's functions to Python workers by value, so executors
    need not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship_by_value(__name__)

# Words end at the six ASCII white-space characters only (fixed by the
# query contracts); bytes.split() without an argument splits at the same six.
BLANK_CLASS = "\\x20\\x09-\\x0D"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: lineage is cut, and a lost executor costs a re-read, not a re-run.
    The folder belongs to the cluster, which clears it like any checkpoint."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_digest(c: Column) -> Column:
    """64-bit digest that, beside an id, tells apart rows whose ids clash."""
    return F.xxhash64(F.coalesce(c, F.lit("")))


def encoded(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null becomes empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``limit`` bytes of text (one
    row at least), which bounds a worker's memory whatever the batch size."""
    for batch in batches:
        column = batch.column(batch.schema.names.index(text))
        start, size = 0, 0
        for i in range(batch.num_rows):
            item = column[i]
            n = 0 if not item.is_valid else item.as_buffer().size
            if size and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)


#: Operators that keep all columns carry them in one struct of this name, so
#: that their own column names can clash with none of the input's.
ROW = "__row"


def as_row(docs: DataFrame, *others: Column) -> DataFrame:
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW), *others)


def row_columns(docs: DataFrame, **replaced: Column) -> list[Column]:
    """The columns of ``docs`` out of the struct again, some of them replaced."""
    return [replaced.get(c, F.col(ROW)[c]).alias(c) for c in docs.columns]
