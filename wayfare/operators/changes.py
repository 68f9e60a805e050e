"""Change capture: envelope, routing, entities, salted keys, latest state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.constants import (ALLIANCE_FIELDS, ALLIANCE_TABLE, DRIVER_FIELDS, DRIVER_TABLE,
                               ORDER_FIELDS, ORDER_TABLE, SALT_BUCKETS, UNKNOWN_ROUTE, USER_FIELDS,
                               USER_TABLE)
from wayfare.functions import keys, times
from wayfare.operators.spread import latest_per_key, merged_per_key
from wayfare.schemas import ENTITY_DATA, strings

# Entity -> its fields, whether missing values become empty text, and the time its key is built on.
ENTITIES = {
    "order": (ORDER_FIELDS, True, ("create_time",)),
    "user": (USER_FIELDS, True, ("create_time", "last_logon_time")),
    "driver": (DRIVER_FIELDS, True, ("create_time",)),
    "alliance": (ALLIANCE_FIELDS, False, ("create_time", "update_time")),
}
STORED_TABLE = {"order": ORDER_TABLE, "user": USER_TABLE, "driver": DRIVER_TABLE,
                "alliance": ALLIANCE_TABLE}
ENVELOPE = strings("table", "type")


def route_of(tbl: Column) -> Column:
    """Entity a change belongs to: order tables by prefix, the others by name."""
    return (F.when(tbl.startswith(ORDER_TABLE), F.lit("order"))
            .when(tbl == USER_TABLE, F.lit("user"))
            .when(tbl == DRIVER_TABLE, F.lit("driver"))
            .when(tbl == ALLIANCE_TABLE, F.lit("alliance"))
            .otherwise(F.lit(UNKNOWN_ROUTE)))


def _defaults(parsed: DataFrame) -> DataFrame:
    """Table, operation and route; a missing table is empty, a missing type inserts."""
    return (parsed.withColumn("table", F.coalesce("table", F.lit("")))
            .withColumn("op", F.coalesce("type", F.lit("insert"))).drop("type")
            .withColumn("route", route_of(F.col("table"))))


def routed(messages: DataFrame) -> DataFrame:
    """Messages with table, operation and route."""
    return _defaults(messages.select(
        *messages.columns, F.inline(F.array(F.from_json("value", ENVELOPE)))))


def _parsed(messages: DataFrame, data: T.StructType) -> DataFrame:
    """Offset, table, operation, route and data; unpacked by a generator, a record is parsed once for all of them."""
    envelope = strings("table", "type").add("data", data)
    return _defaults(messages.select("offset", F.inline(F.array(F.from_json("value", envelope)))))


def parsed_changes(messages: DataFrame) -> DataFrame:
    """Records of all entities, parsed once: ``data`` has the fields of every entity, those of others are null.

    One schema for all rather than a variant: numbers keep the text they came with.
    """
    return _parsed(messages, strings(*dict.fromkeys(f.name for data in ENTITY_DATA.values() for f in data)))


def rows_of_entity(parsed: DataFrame, entity: str) -> DataFrame:
    fields, fill, _ = ENTITIES[entity]

    def value(name: str) -> Column:
        got = F.col(f"data.{name}")
        return (F.coalesce(got, F.lit("")) if fill else got).alias(name)

    return parsed.where(F.col("route") == entity).select(
        "table", "op", F.col("data.id_").alias("id"), *[value(f) for f in fields], "offset")


def entity_rows(messages: DataFrame, entity: str) -> DataFrame:
    """Records of one entity as its bean: table, id, operation and the entity's fields, all text."""
    return rows_of_entity(_parsed(messages, ENTITY_DATA[entity]), entity)


def key_time(entity: str) -> Column:
    """Compact time a record is keyed on: the first of its times that is not blank."""
    _, _, candidates = ENTITIES[entity]
    *first, last = candidates
    filled = [F.when(F.trim(F.col(c)) != "", F.col(c)) for c in first]
    return times.compact_time(F.coalesce(*filled, F.col(last)) if filled else F.col(last))


def _keyed(rows: DataFrame, entity: str, buckets: int) -> DataFrame:
    moment = key_time(entity)
    rows = rows.where(F.col("op").isin("insert", "update") & F.col("id").isNotNull() & moment.isNotNull())
    return rows.select(keys.salted_key(F.col("id"), moment, buckets).alias("rowkey"), *rows.columns)


def keyed_writes(messages: DataFrame, entity: str, buckets: int = SALT_BUCKETS) -> DataFrame:
    """Rows to store: inserts and updates with a usable id and time, under their salted key."""
    return _keyed(entity_rows(messages, entity), entity, buckets)


def latest_state(messages: DataFrame, entity: str, buckets: int = SALT_BUCKETS) -> DataFrame:
    """The stored table: per row key the write with the highest offset, or cell by cell where cells may be absent."""
    return current(keyed_writes(messages, entity, buckets), entity, ["offset"])


def latest_of_changes(parsed: DataFrame, entity: str, buckets: int = SALT_BUCKETS) -> DataFrame:
    """:func:`latest_state` of records that are parsed already."""
    return current(_keyed(rows_of_entity(parsed, entity), entity, buckets), entity, ["offset"])


def current(writes: DataFrame, entity: str, version: list[str]) -> DataFrame:
    """Writes folded per row key. Entities whose absent fields are filled always write every cell."""
    _, fill, _ = ENTITIES[entity]
    return (latest_per_key if fill else merged_per_key)(writes, ["rowkey"], version)


def entity_maps(parsed: DataFrame) -> DataFrame:
    """Each routed record as a map of its fields, without nulls; ``kind`` is its entity. One pass over all entities."""
    maps = F.lit(None)
    for entity, (fields, fill, _) in ENTITIES.items():
        pairs = [F.lit("table"), F.col("table"), F.lit("operatorType"), F.col("op"),
                 F.lit("id_" if entity == "alliance" else "id"), F.col("data.id_")]
        for field in fields:
            got = F.col(f"data.{field}")
            pairs += [F.lit(field), F.coalesce(got, F.lit("")) if fill else got]
        maps = F.when(F.col("route") == entity, F.create_map(*pairs)).otherwise(maps)
    return parsed.where(F.col("route") != UNKNOWN_ROUTE).select(
        F.col("route").alias("kind"), "offset", F.map_filter(maps, lambda _, v: v.isNotNull()).alias("entity"))


def bucket_histogram(writes: DataFrame) -> DataFrame:
    """Rows per key range with the range's upper boundary."""
    bucket = keys.key_range(F.col("rowkey"))
    return (writes.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("row_count"))
            .withColumn("boundary", F.concat(F.lpad(F.col("bucket").cast("string"), 4, "0"), F.lit("|"))))
