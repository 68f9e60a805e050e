"""Batch readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.schemas import BLOCK_EVENT, GEOJSON, ORDER_STORE, TASK_EVENT


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_scan(orders: DataFrame) -> DataFrame:
    """The four columns the station job needs, all strings; the scan below reads no others."""
    return orders.select(*[orders[f.name].cast(f.dataType).alias(f.name) for f in ORDER_STORE])


def order_store(spark: SparkSession, path: str) -> DataFrame:
    """Stored orders, read with a fixed schema so that no file is opened to infer one."""
    return spark.read.schema(ORDER_STORE).parquet(path)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def geojson(spark: SparkSession, path: str) -> DataFrame:
    """Feature collections, one file each."""
    return spark.read.schema(GEOJSON).json(path, multiLine=True)


def parsed_task_events(lines: DataFrame, *parts: str) -> DataFrame:
    """Event-log lines held in column ``value``, parsed to the parts a report uses."""
    schema = T.StructType([f for f in TASK_EVENT if f.name in ("Event", "Task Info", *parts)])
    return lines.select(F.inline(F.array(F.from_json("value", schema))))


def parsed_block_events(lines: DataFrame) -> DataFrame:
    """Event-log lines held in column ``value``, parsed to the blocks that tasks stored or dropped."""
    return lines.select(F.inline(F.array(F.from_json("value", BLOCK_EVENT))))


def event_log(spark: SparkSession, path: str) -> DataFrame:
    """Spark event-log lines, limited to the parts task reports use."""
    return spark.read.schema(TASK_EVENT).json(path)
