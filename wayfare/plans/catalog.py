"""One registered query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.constants import CHENGDU, HEX_RESOLUTION, XIAN
from wayfare.functions import geo, keys, text, times
from wayfare.operators import changes, members, metrics, orders, stations, tracks
from wayfare.schemas import DISTRICT_DOCUMENT, GEOJSON
from wayfare.sources import derived
from wayfare.sources.sinks import stored_track
from wayfare.sources.tables import order_scan, parsed_block_events, parsed_task_events, table

Query = Callable[[SparkSession, str], DataFrame]

# District shapes: plain, edge-touching, overlapping, concave, empty.
DISTRICTS = [
    ("west", "0898", "110.19,19.79;110.30,19.79;110.30,20.06;110.19,20.06;110.19,19.79"),
    ("middle", "0898", "110.32,19.79;110.45,19.79;110.45,20.06;110.32,20.06;110.32,19.79"),
    ("south", "0898", "110.19,19.79;110.60,19.79;110.60,19.83;110.19,19.83;110.19,19.79"),
    ("notch", "0898", "110.46,19.84;110.60,19.84;110.53,19.95;110.60,20.06;110.46,20.06;110.46,19.84"),
    ("empty", "0898", ""),
]

STATION_CITY, STATION_DISTRICT = "83", "west"
SCORE_LOW, SCORE_HIGH = 20_000, 60_000
RETAINED_AS_OF = "2024-01-30 12:00:00"
BATCH_BOUNDARY = "2024-01-15 00:00:00"
QUERY_FROM, QUERY_TO = "2024-01-05 06:00:00", "2024-01-20 18:00:00"


# Stations.

def _gridded(spark: SparkSession, folder: str) -> DataFrame:
    return stations.grid_cells(order_scan(derived.orders_raw(spark, folder)))


def _station_table(spark: SparkSession, folder: str) -> DataFrame:
    return stations.stations(order_scan(derived.orders_raw(spark, folder)),
                             stations.district_table(spark, DISTRICTS))


def grid_cell_levels(spark: SparkSession, folder: str) -> DataFrame:
    """The cell of every order at three resolutions."""
    cell = F.col("cell")
    return _gridded(spark, folder).select("order_id", *[
        geo.cell_parent(cell, HEX_RESOLUTION - r).alias(f"cell_{r}") for r in (11, 9, 6)])


def hot_cell_parents(spark: SparkSession, folder: str) -> DataFrame:
    """Hot cells rolled up to three coarser resolutions."""
    hot = stations.hot_cells(_gridded(spark, folder))
    levels = [stations.cell_rollup(hot, r).withColumn("resolution", F.lit(r)) for r in (11, 9, 6)]
    return levels[0].unionByName(levels[1]).unionByName(levels[2])


def station_districts(spark: SparkSession, folder: str) -> DataFrame:
    chosen = stations.cell_representatives(_gridded(spark, folder), stations.MIN_CELL_ORDERS)
    labelled = stations.label_districts(chosen, stations.district_table(spark, DISTRICTS), None)
    return labelled.select("order_id", "city_id", "starting_lng", "starting_lat", "district_name")


def supplier_districts(spark: SparkSession, folder: str) -> DataFrame:
    """Customers' pickups with every supplier district they lie in; districts overlap."""
    districts = derived.supplier_polygons(spark, folder).withColumnRenamed("supplier", "position")
    return stations.label_districts(derived.customer_points(spark, folder), districts)


def district_rows(spark: SparkSession, folder: str) -> DataFrame:
    documents = derived.district_documents(spark, folder).withColumn(
        "document", F.from_json("document", DISTRICT_DOCUMENT))
    return stations.district_rows(documents)


def geojson_rings(spark: SparkSession, folder: str) -> DataFrame:
    collections = derived.geojson_documents(spark, folder).select(
        F.inline(F.array(F.from_json("document", GEOJSON))))
    rings = stations.geojson_rings(collections)
    return rings.select("name", "polygon_no", "ring_no", F.posexplode("points").alias("seq", "p")).select(
        "name", "polygon_no", "ring_no", "seq", "p.lng", "p.lat")


# Order lines.

def orders_by_topic(spark: SparkSession, folder: str) -> DataFrame:
    parsed = orders.parse_by_topic(derived.order_messages(spark, folder))
    return parsed.select("offset", "topic", "city_code", "order_id", "create_day", "passengers")


def order_overview(spark: SparkSession, folder: str) -> DataFrame:
    return orders.order_overview(
        orders.order_totals(derived.order_messages(spark, folder)),
        tracks.hourly_orders(_points(spark, folder)))


# Change capture.

def _changes(entity: str) -> Query:
    return lambda spark, folder: changes.entity_rows(derived.change_messages(spark, folder), entity)


def cdc_routes(spark: SparkSession, folder: str) -> DataFrame:
    return (changes.routed(derived.change_messages(spark, folder))
            .groupBy("table", "op", "route").agg(F.count("*").alias("messages")))


def cdc_latest(spark: SparkSession, folder: str) -> DataFrame:
    latest = changes.latest_state(derived.change_messages(spark, folder), "order")
    return latest.select("rowkey", "table", "op", "id", "create_time", "state", "order_type",
                         "pay_time", "offset")


def _latest_small(entity: str, *columns: str) -> Query:
    return lambda spark, folder: changes.latest_state(
        derived.change_messages(spark, folder), entity).select("rowkey", "id", *columns)


def cdc_merged_alliances(spark: SparkSession, folder: str) -> DataFrame:
    merged = changes.latest_state(derived.alliance_updates(spark, folder), "alliance")
    return merged.select("rowkey", "id", "op", "alliance_name", "linkman", "update_time", "state", "offset")


def entity_map(spark: SparkSession, folder: str) -> DataFrame:
    mapped = changes.entity_maps(changes.parsed_changes(derived.change_messages(spark, folder)))
    pairs = F.transform(F.map_entries("entity"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return mapped.select("kind", "offset", F.array_join(F.array_sort(pairs), "|").alias("entity"))


def salted_keys(spark: SparkSession, folder: str) -> DataFrame:
    o = derived.orders_raw(spark, folder)
    moment = times.compact_time(F.concat_ws(" ", "departure_day", "departure_time"))
    return o.select("order_id", moment.alias("moment"),
                    keys.salt(F.concat_ws("_", F.col("order_id"), moment)).alias("salt"),
                    keys.salted_key(F.col("order_id"), moment).alias("rowkey"))


def bucket_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return changes.bucket_histogram(changes.keyed_writes(derived.change_messages(spark, folder), "order"))


# Tracks.

def _points(spark: SparkSession, folder: str) -> DataFrame:
    return tracks.gps_points(derived.gps_messages(spark, folder))


def _tracked(spark: SparkSession, folder: str) -> DataFrame:
    return tracks.track_messages(derived.gps_messages(spark, folder))


def new_orders(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    return tracks.new_orders(points.where(F.col("time") >= BATCH_BOUNDARY),
                             points.where(F.col("time") < BATCH_BOUNDARY))


def track_range(spark: SparkSession, folder: str) -> DataFrame:
    """Every order asked for its own first half: start inclusive, middle exclusive."""
    points = _points(spark, folder)
    middle = F.floor((F.col("start_epoch") + F.col("end_epoch")) / F.lit(2)).cast("long")
    requests = tracks.order_spans(points).select(
        "order_id", F.col("start_epoch").alias("from_epoch"), middle.alias("to_epoch"))
    return tracks.track_ranges(points, requests).select("rowkey", "order_id", "epoch", "lng", "lat", "offset")


def order_history(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    history = tracks.order_history(points, tracks.order_spans(points))
    return history.select("rowkey", "order_id", "driver_id", "epoch", "lng", "lat", "offset")


TRACK_POINT = (("driverId", "string"), ("orderId", "string"), ("timestamp", "bigint"),
               ("lng", "double"), ("lat", "double"))


# Metrics.

def _task_reports(report: Callable[[DataFrame], DataFrame], *parts: str) -> Query:
    return lambda spark, folder: report(parsed_task_events(derived.task_events(spark, folder), *parts))


def _retained(kept: Callable[[DataFrame, Column], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        snapshots = table(spark, folder, "events").select("event_id", F.col("ts").alias("captured_at"))
        return kept(snapshots, F.expr(f"timestamp_ntz'{RETAINED_AS_OF}'")).select("event_id")

    return run


# Keyed members.

def _scores(spark: SparkSession, folder: str) -> DataFrame:
    return members.scores(derived.increments(spark, folder))


def _sets(spark: SparkSession, folder: str) -> DataFrame:
    """A set per event type: the users with the days they were seen on."""
    return table(spark, folder, "events").select(
        F.col("event_type").alias("key"),
        F.concat_ws("_", F.col("user_id").cast("string"),
                    times.day_of(F.col("ts").cast("string"))).alias("member"))


# Scalars and text.

def time_formats(spark: SparkSession, folder: str) -> DataFrame:
    """Every event's time through the time helpers; every seventh text lacks its time part."""
    second = times.to_epoch(F.col("ts"))
    full = times.epoch_to_text(second)
    shown = F.when(F.col("event_id") % 7 == 0, times.day_of(full)).otherwise(full)
    minute = F.substring(F.translate(full, "- :", ""), 1, 12)
    return table(spark, folder, "events").select(
        "event_id", full.alias("full_text"),
        times.compact_time(shown).alias("compact"), times.compact_day(shown).alias("no_dashes"),
        times.minus_days(minute).alias("half_month_back"),
        times.epoch_millis_to_text(second * 1000 + F.col("event_id") % 1000).alias("from_millis"),
        times.month_suffix(F.col("ts")).alias("month"), times.hour_of(full).alias("hour"))


def html_filter(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", text.safe_html(F.col("html")).alias("html"))


QUERIES: dict[str, Query] = {
    # Stations.
    "order_scan": lambda s, d: order_scan(derived.orders_raw(s, d)),
    "grid_cells": _gridded,
    "square_cells": lambda s, d: stations.square_cells(order_scan(derived.orders_raw(s, d))),
    "hot_cells": lambda s, d: stations.hot_cells(_gridded(s, d)),
    "grid_cell_levels": grid_cell_levels,
    "hot_cell_parents": hot_cell_parents,
    "hot_cell_orders": lambda s, d: stations.hot_cell_orders(_gridded(s, d)),
    "cell_representative": lambda s, d: stations.cell_representatives(_gridded(s, d)),
    "station_districts": station_districts,
    "supplier_districts": supplier_districts,
    "stations": _station_table,
    "station_query": lambda s, d: stations.query_stations(
        _station_table(s, d), STATION_CITY, STATION_DISTRICT),
    "station_counts": lambda s, d: stations.station_counts(_station_table(s, d), STATION_CITY),
    "station_sample": lambda s, d: stations.station_sample(_station_table(s, d)),
    "polygon_rings": lambda s, d: stations.polygon_rings(derived.supplier_polygons(s, d)),
    "district_rows": district_rows,
    "geojson_rings": geojson_rings,
    # Order lines.
    "order_lines_valid": lambda s, d: orders.line_checks(derived.order_messages(s, d)),
    "order_lines_parsed": lambda s, d: orders.parse_lines(derived.order_messages(s, d)).drop("key"),
    "order_detail": lambda s, d: orders.order_detail(derived.order_messages(s, d)),
    "orders_by_topic": orders_by_topic,
    "order_counts": lambda s, d: orders.order_counts(derived.order_messages(s, d)),
    "passenger_counts": lambda s, d: orders.passenger_counts(derived.order_messages(s, d)),
    "rejected_lines": lambda s, d: orders.reject_count(derived.order_messages(s, d)),
    "order_overview": order_overview,
    # Change capture.
    "cdc_routes": cdc_routes,
    "cdc_orders": _changes("order"),
    "cdc_users": _changes("user"),
    "cdc_drivers": _changes("driver"),
    "cdc_alliances": _changes("alliance"),
    "cdc_latest": cdc_latest,
    "cdc_latest_users": _latest_small("user", "create_time", "last_logon_time", "city_name"),
    "cdc_latest_drivers": _latest_small("driver", "driver_name", "cancel_count"),
    "cdc_latest_alliances": _latest_small("alliance", "alliance_name", "linkman"),
    "cdc_merged_alliances": cdc_merged_alliances,
    "entity_map": entity_map,
    "salted_keys": salted_keys,
    "bucket_histogram": bucket_histogram,
    # Tracks.
    "gps_points": _points,
    "track_table": lambda s, d: tracks.track_table(_points(s, d)),
    "live_orders": lambda s, d: tracks.live_orders(_points(s, d), CHENGDU),
    "new_orders": new_orders,
    "order_span": lambda s, d: tracks.order_spans(_points(s, d)),
    "order_lifecycle": lambda s, d: tracks.order_lifecycle(_tracked(s, d)),
    "track_list": lambda s, d: tracks.track_list(_tracked(s, d)),
    "track_slice": lambda s, d: tracks.list_range(tracks.track_list(_tracked(s, d)), 1, -2),
    "track_index": lambda s, d: tracks.list_index(tracks.track_list(_tracked(s, d)), -1),
    "track_trim": lambda s, d: tracks.list_trim(tracks.track_list(_tracked(s, d)), -3, -1),
    "track_replay": lambda s, d: tracks.track_replay(_tracked(s, d)),
    "track_range": track_range,
    "track_query": lambda s, d: tracks.query_tracks(_points(s, d), QUERY_FROM, QUERY_TO, XIAN),
    "track_query_points": lambda s, d: tracks.query_track_points(_points(s, d), QUERY_FROM),
    "typed_track": lambda s, d: tracks.typed_rows(stored_track(_points(s, d)), TRACK_POINT),
    "order_history": order_history,
    "hourly_orders": lambda s, d: tracks.hourly_orders(_points(s, d)),
    "hourly_series": lambda s, d: tracks.hourly_series(tracks.hourly_orders(_points(s, d))),
    "hour_count_map": lambda s, d: tracks.hour_count_map(tracks.hourly_orders(_points(s, d))),
    # Metrics.
    "gauge_extract": lambda s, d: metrics.gauge_values(derived.gauge_snapshots(s, d), "app"),
    "task_metrics": _task_reports(metrics.task_metrics, "Task Metrics"),
    "shuffle_metrics": _task_reports(metrics.shuffle_metrics, "Task Metrics"),
    "io_metrics": _task_reports(metrics.io_metrics, "Task Metrics"),
    "task_info": _task_reports(metrics.task_info),
    "block_statuses": lambda s, d: metrics.block_statuses(parsed_block_events(derived.task_events(s, d))),
    "failed_tasks": _task_reports(
        metrics.failed_tasks, "Stage Attempt ID", "Task End Reason"),
    "record_total": lambda s, d: metrics.record_total(derived.order_messages(s, d)),
    "batch_throughput": lambda s, d: metrics.batch_throughput(derived.batch_reports(s, d)),
    "slow_batches": lambda s, d: metrics.slow_batches(derived.batch_delays(s, d), 1),
    "metrics_retained": _retained(metrics.retained),
    "listener_retained": _retained(metrics.listener_records),
    # Keyed members.
    "counter_increments": lambda s, d: members.counter_totals(derived.increments(s, d)),
    "set_cardinality": lambda s, d: members.cardinality(derived.set_members(s, d)),
    "member_rank": lambda s, d: members.member_ranks(_scores(s, d)),
    "member_rank_desc": lambda s, d: members.member_ranks(_scores(s, d), descending=True),
    "top_members": lambda s, d: members.rank_range(_scores(s, d), 0, 9, descending=True),
    "bottom_members": lambda s, d: members.rank_range(_scores(s, d), -5, -1, descending=True),
    "score_range": lambda s, d: members.score_range(_scores(s, d), SCORE_LOW, SCORE_HIGH),
    "score_count": lambda s, d: members.score_counts(_scores(s, d), SCORE_LOW, SCORE_HIGH),
    "rank_removed": lambda s, d: members.remove_rank_range(_scores(s, d), 2, -3),
    "score_removed": lambda s, d: members.remove_score_range(_scores(s, d), SCORE_LOW, SCORE_HIGH),
    "set_union": lambda s, d: members.set_union(_sets(s, d), ["click", "purchase"]),
    "set_intersect": lambda s, d: members.set_intersect(_sets(s, d), ["click", "purchase", "view"]),
    "set_except": lambda s, d: members.set_except(_sets(s, d), "click", ["purchase", "view"]),
    # Scalars and text.
    "time_formats": time_formats,
    "order_json": lambda s, d: derived.orders_raw(s, d).select(
        "order_id", text.as_json("order_id", "city_id", "starting_lng", "starting_lat").alias("object")),
    "html_filter": html_filter,
    "word_count": lambda s, d: members.word_count(table(s, d, "documents"), "text"),
}
