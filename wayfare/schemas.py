"""Schemas of the inputs and stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

from wayfare.constants import ALLIANCE_FIELDS, DRIVER_FIELDS, ORDER_FIELDS, USER_FIELDS


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Messages of any topic.
MESSAGE = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("offset", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
])

ORDER_STORE = strings("order_id", "city_id", "starting_lng", "starting_lat")

# The stored track, laid out by city and day.
TRACK = (strings("rowkey", "driver_id", "order_id").add("epoch", T.LongType()).add("time", T.StringType())
         .add("lng", T.StringType()).add("lat", T.StringType()).add("offset", T.LongType())
         .add("city_code", T.StringType()).add("day", T.StringType()))

# Change records: entity fields under ``data``; the id field is always ``id_``.
ENTITY_DATA = {
    "order": strings("id_", *ORDER_FIELDS),
    "user": strings("id_", *USER_FIELDS),
    "driver": strings("id_", *DRIVER_FIELDS),
    "alliance": strings("id_", *ALLIANCE_FIELDS),
}

# District documents: a city lists its districts one level below.
_DISTRICT_LEAF = strings("name", "citycode", "polyline", "level")
_DISTRICT_NODE = T.StructType(
    _DISTRICT_LEAF.fields + [T.StructField("districts", T.ArrayType(_DISTRICT_LEAF))])
DISTRICT_DOCUMENT = T.StructType([T.StructField("districts", T.ArrayType(_DISTRICT_NODE))])

# GeoJSON: multipolygons as polygons > rings > points > numbers.
_COORDINATES = T.ArrayType(T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))
GEOJSON = T.StructType([
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("properties", strings("name")),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()),
            T.StructField("coordinates", _COORDINATES)]))])))])

GAUGE_SNAPSHOT = T.StructType([
    T.StructField("gauges", T.MapType(
        T.StringType(), T.StructType([T.StructField("value", T.LongType())])))])


def _longs(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.LongType()) for n in names])


# The part of Spark's event log that task reports are read from.
TASK_EVENT = T.StructType([
    T.StructField("Event", T.StringType()),
    T.StructField("Stage ID", T.LongType()),
    T.StructField("Stage Attempt ID", T.LongType()),
    T.StructField("Task End Reason", strings(
        "Reason", "Kill Reason", "Class Name", "Description", "Message")),
    T.StructField("Task Info", T.StructType([
        T.StructField("Task ID", T.LongType()),
        T.StructField("Host", T.StringType()),
        T.StructField("Speculative", T.BooleanType()),
        T.StructField("Failed", T.BooleanType()),
        T.StructField("Killed", T.BooleanType()),
        T.StructField("Finish Time", T.LongType())])),
    T.StructField("Task Metrics", T.StructType([
        *_longs("Executor Deserialize Time", "Executor Deserialize CPU Time", "Executor Run Time",
                "Executor CPU Time", "Result Size", "JVM GC Time", "Result Serialization Time",
                "Memory Bytes Spilled", "Disk Bytes Spilled", "Peak Execution Memory").fields,
        T.StructField("Shuffle Read Metrics", _longs(
            "Remote Blocks Fetched", "Local Blocks Fetched", "Remote Bytes Read",
            "Local Bytes Read", "Fetch Wait Time", "Total Records Read")),
        T.StructField("Shuffle Write Metrics", _longs(
            "Shuffle Bytes Written", "Shuffle Records Written", "Shuffle Write Time")),
        T.StructField("Input Metrics", _longs("Bytes Read", "Records Read")),
        T.StructField("Output Metrics", _longs("Bytes Written", "Records Written"))])),
])

# The part of it that tells which blocks a task stored or dropped.
BLOCK_EVENT = T.StructType([
    T.StructField("Event", T.StringType()),
    T.StructField("Task Info", _longs("Task ID")),
    T.StructField("Task Metrics", T.StructType([
        T.StructField("Updated Blocks", T.ArrayType(T.StructType([
            T.StructField("Block ID", T.StringType()),
            T.StructField("Status", T.StructType([
                T.StructField("Storage Level", T.StructType([
                    T.StructField("Use Disk", T.BooleanType()), T.StructField("Use Memory", T.BooleanType())])),
                *_longs("Memory Size", "Disk Size").fields]))])))])),
])

# A streaming progress report, as the query writes it.
PROGRESS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("batchId", T.LongType()),
    T.StructField("numInputRows", T.LongType()),
    T.StructField("durationMs", T.MapType(T.StringType(), T.LongType())),
])
