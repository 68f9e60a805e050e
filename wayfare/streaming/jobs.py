"""Streaming jobs: running totals, change capture, tracks and order lifecycles.

Every job stores the rows of a batch in maintained tables (``wayfare.sources.maintained``): one delta per batch, replaced when the
batch is replayed, and folded into the table's base every ``compact_every`` batches while the job runs. Aggregating
jobs run in update mode and store only the keys a batch changed. Nothing is gathered on the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wayfare.functions.times import day_of
from wayfare.operators import changes, members, orders, tracks
from wayfare.operators.spread import folded_per_key
from wayfare.sources.files import Files
from wayfare.sources.maintained import MaintainedTable
from wayfare.streaming import lifecycle

COMPACT_EVERY = 50
Rows = Callable[[DataFrame], DataFrame]


def trigger_of(seconds: int | None) -> dict:
    return {"processingTime": f"{seconds} seconds"} if seconds else {"availableNow": True}


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint gives its query, for as long as the checkpoint lives."""
    return json.loads(Files(spark, checkpoint).text("metadata"))["id"]


def start(rows: DataFrame, stores: Mapping[MaintainedTable, Rows | None], checkpoint: str, mode: str = "update",
          seconds: int | None = None, name: str | None = None, compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Run a stream into maintained tables every ``seconds``, or over what is there and then stop.

    A store may have a function of its own from the batch to its rows. The batch is evaluated once: one store writes it
    as it comes, several read it from the cache. The checkpoint commits a batch after all have been written; an
    older checkpoint whose tables a newer one has taken over fails instead of writing.
    """
    run: list[str] = []

    def each(batch: DataFrame, batch_id: int) -> None:
        if not run:
            run.append(run_of(batch.sparkSession, checkpoint))
        shared = batch.persist() if len(stores) > 1 else batch
        try:
            for store, own in stores.items():
                store.append(own(shared) if own else shared, run[0], batch_id)
        finally:
            if len(stores) > 1:
                batch.unpersist()
        if (batch_id + 1) % compact_every == 0:
            for store in stores:
                store.compact()

    writer = rows.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**trigger_of(seconds)).start()


def start_preview(rows: DataFrame, mode: str = "append", n: int = 20, seconds: int | None = None) -> StreamingQuery:
    """Print the first rows of every batch."""
    return (rows.writeStream.format("console").outputMode(mode).option("numRows", n)
            .trigger(**trigger_of(seconds)).start())


# Running order and passenger totals.

def order_total_table(spark: SparkSession, path: str) -> MaintainedTable:
    return MaintainedTable(spark, path, ["city_code", "create_day"])


def start_order_totals(messages: DataFrame, path: str, checkpoint: str, seconds: int | None = None,
                       compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Lifetime orders and passengers per city and day; both measures from one state."""
    store = order_total_table(messages.sparkSession, path)
    return start(orders.order_totals(messages), {store: None}, checkpoint, seconds=seconds, name="order_totals",
                 compact_every=compact_every)


def current_order_totals(spark: SparkSession, path: str) -> DataFrame:
    return order_total_table(spark, path).current()


# Word counts.

def word_table(spark: SparkSession, path: str) -> MaintainedTable:
    return MaintainedTable(spark, path, ["word"])


def start_word_count(lines: DataFrame, path: str, checkpoint: str, seconds: int | None = None,
                     compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    store = word_table(lines.sparkSession, path)
    return start(members.word_count(lines, "value"), {store: None}, checkpoint, seconds=seconds, name="word_count",
                 compact_every=compact_every)


def current_word_counts(spark: SparkSession, path: str) -> DataFrame:
    return word_table(spark, path).current()


# Change capture.

def entity_table(spark: SparkSession, path: str, entity: str) -> MaintainedTable:
    return MaintainedTable(spark, f"{path}/{changes.STORED_TABLE[entity]}", ["rowkey"], ["offset"],
                           fold=lambda rows, order: changes.current(rows, entity, order))


def start_changes(messages: DataFrame, path: str, checkpoint: str, seconds: int | None = None,
                  compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Route change records to their stored tables, each batch reduced to the last write per key.

    Records are parsed once, before the batch is shared by the tables.
    """
    stores = {entity_table(messages.sparkSession, path, e): partial(changes.latest_of_changes, entity=e)
              for e in changes.STORED_TABLE}
    return start(changes.parsed_changes(messages), stores, checkpoint, mode="append", seconds=seconds, name="changes",
                 compact_every=compact_every)


def current_entities(spark: SparkSession, path: str, entity: str) -> DataFrame:
    return entity_table(spark, path, entity).current()


# GPS tracks and order details: one row per row key, however often a message is delivered.

def track_table(spark: SparkSession, path: str) -> MaintainedTable:
    return MaintainedTable(spark, path, ["order_id", "rowkey"], ["offset"], partitions=["city_code", "day"])


def start_tracks(messages: DataFrame, path: str, checkpoint: str, seconds: int | None = None,
                 compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Track points by city and day, each order's points together; compaction rewrites the days that were touched."""
    points = tracks.gps_points(messages).withColumn("day", day_of(F.col("time")))
    return start(points, {track_table(messages.sparkSession, path): None}, checkpoint, mode="append", seconds=seconds,
                 name="tracks", compact_every=compact_every)


def current_tracks(spark: SparkSession, path: str) -> DataFrame:
    return track_table(spark, path).current()


def order_detail_table(spark: SparkSession, path: str) -> MaintainedTable:
    return MaintainedTable(spark, path, ["rowkey"], ["offset"], partitions=["year", "month"])


def start_order_detail(messages: DataFrame, path: str, checkpoint: str, seconds: int | None = None,
                       compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Order-detail rows by year and month."""
    return start(orders.order_detail(messages), {order_detail_table(messages.sparkSession, path): None}, checkpoint,
                 mode="append", seconds=seconds, name="order_detail", compact_every=compact_every)


def current_order_detail(spark: SparkSession, path: str) -> DataFrame:
    return order_detail_table(spark, path).current()


# Order lifecycles and first points.

def lifecycle_table(spark: SparkSession, path: str) -> MaintainedTable:
    """What the state of an order knew when it was written; an order that ended and came back has several lives."""
    return MaintainedTable(spark, path, ["city_code", "order_id", "life"])


def start_lifecycles(messages: DataFrame, path: str, checkpoint: str, seconds: int | None = None,
                     compact_every: int = COMPACT_EVERY, idle_s: int | None = None) -> StreamingQuery:
    """Opening, latest and closing state of orders. The state keeps open orders only.

    With ``idle_s``, an order without a message for so long (of processing time) leaves the state too, unclosed.
    """
    store = lifecycle_table(messages.sparkSession, path)
    return start(lifecycle.lives(tracks.track_messages(messages), idle_s), {store: None}, checkpoint, seconds=seconds,
                 name="lifecycles", compact_every=compact_every)


def current_lifecycles(spark: SparkSession, path: str) -> DataFrame:
    return lifecycle.orders_of_lives(lifecycle_table(spark, path).current())


def first_seen_table(spark: SparkSession, path: str) -> MaintainedTable:
    def earliest(rows: DataFrame, order: list[str]) -> DataFrame:
        return folded_per_key(rows, ["city_code", "order_id"], {"first_epoch": F.min("first_epoch"),
                                                                **{c: F.max(c) for c in ("run", "batch_id")}})

    return MaintainedTable(spark, path, ["city_code", "order_id"], fold=earliest)


def start_first_seen(messages: DataFrame, path: str, checkpoint: str, seconds: int | None = None,
                     compact_every: int = COMPACT_EVERY, expire_s: int | None = None) -> StreamingQuery:
    """First point time of each order; the hourly counts are derived from what is stored.

    With ``expire_s`` the state forgets an order's hour that long after its first point there in event time, and drops
    points that come later than that. The time is then stored to the hour: of each order and hour one row is passed on, and the
    table keeps the earliest, so that the counts are right in whatever order points come, and an order that comes back is not counted again.
    """
    points = tracks.gps_points(messages)
    if expire_s is None:
        first, mode = tracks.first_seen(points), "update"
    else:
        hours = points.select("city_code", "order_id", (F.col("epoch") - F.pmod(F.col("epoch"), F.lit(3600))).alias("first_epoch"),
                              F.timestamp_seconds("epoch").alias("at")).withWatermark("at", f"{expire_s} seconds")
        first, mode = hours.dropDuplicatesWithinWatermark(["city_code", "order_id", "first_epoch"]).drop("at"), "append"
    return start(first, {first_seen_table(messages.sparkSession, path): None}, checkpoint, mode=mode, seconds=seconds,
                 name="first_seen", compact_every=compact_every)


def current_hourly_orders(spark: SparkSession, path: str) -> DataFrame:
    return tracks.hourly_from_first_seen(first_seen_table(spark, path).current())
