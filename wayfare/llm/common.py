"""Helpers of the text operators: inputs, tables in the shared folder, Arrow columns."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.errors import PySparkTypeError, PySparkValueError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wayfare.session import checkpoint_dir
from wayfare.sources.tables import table

__all__ = ["arrow_holds", "as_rows", "binary", "brief_shuffles", "kept", "pieces_of", "shared_path", "small_batches", "stored", "table", "texts", "tidied", "tidied_group", "vectors", "whole_text"]


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors and the driver see."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Rows written once to the shared folder and read back: lineage ends here, executors may go."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, size: int = 4 << 20) -> Iterator[None]:
    """Arrow batches of about ``size`` bytes for what runs inside, unless the session has a limit of its own.

    Each side holds a batch outside the heap, and the JVM keeps that memory; by default a batch may be a whole partition.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.unset(key)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """What runs inside drops its shuffle files when it ends, unless the session says otherwise; else they stay until the driver
    happens to collect its garbage. For actions whose result is stored: it must not be read from their shuffles again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key)


def arrow_holds(schema: StructType) -> bool:
    """Whether rows of the schema can go through Python as Arrow batches."""
    try:
        to_arrow_schema(schema)
    except (PySparkTypeError, PySparkValueError):
        return False
    return True


_KEPT: dict[str, Any] = {}


def kept(key: str, make: Callable[[], Any]) -> Any:
    """What the tasks of an operator share in a Python worker, made once; it goes with the next ``tidied`` task."""
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def make_room() -> None:
    """Give what this process keeps or has freed back to the system, the C library's share too where that can be asked."""
    _KEPT.clear()
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[
        [Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` in workers that hold neither what tasks of other operators left there, nor afterwards what it freed.

    Spark uses its Python workers for all operators in turn, and they stay while other stages run.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        yield from run(batches)
        make_room()

    return whole


def tidied_group(run: Callable[[tuple, pa.Table], pa.Table]) -> Callable[[tuple, pa.Table], pa.Table]:
    """As ``tidied``, for the function of a group."""

    def whole(key: tuple, table: pa.Table) -> pa.Table:
        make_room()
        out = run(key, table)
        make_room()
        return out

    return whole


def as_rows(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` as one struct, ``row``: no name inside can clash with an operator's own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def texts(docs: DataFrame) -> DataFrame:
    """Id and whole text of every document, and no other column; a null text is empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))


def binary(values: Iterable[bytes]) -> pa.Array:
    return pa.array(list(values), pa.binary())


def vectors(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column of numpy rows, without turning each number into an object."""
    ends = np.cumsum([0, *map(len, rows)])
    flat = np.concatenate(rows) if rows else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def pieces_of(batches: Iterator[pa.RecordBatch], size: Callable[[pa.RecordBatch], np.ndarray],
              limit: int) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that a piece weighs at most ``limit``, or is a single heavier row."""
    for batch in batches:
        weight = size(batch)
        start, total = 0, 0
        for i, w in enumerate(weight):
            if total and total + w > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += w
        if start < batch.num_rows:
            yield batch.slice(start)
