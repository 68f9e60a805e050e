"""GPS tracks: parsing, live orders, spans, lists, replay, hourly counts, history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.constants import GPS_TOPICS
from wayfare.functions import keys, times
from wayfare.operators.orders import city_of_topic
from wayfare.operators.spread import ROWS_PER_TASK, join_unique, latest_per_key, number_rows

HOURS = 24


def track_messages(messages: DataFrame, strict: bool = False) -> DataFrame:
    """Points and end markers of GPS messages; anything else is dropped.

    A text with a comma is a point and carries its own time. Another text holding ``end`` closes the
    order named by the message key, at the time of the message.
    """
    value = F.col("value")
    is_point = value.contains(",")
    parts = F.split(value, ",", -1)

    def part(i: int) -> Column:
        return F.get(parts, F.lit(i))

    # A marker has a single part, so the fields of a point are null for it without a condition;
    # unconditional uses of the split share one evaluation.
    epoch = part(2).try_cast("long")
    return messages.where(is_point | value.contains("end")).select(
        city_of_topic(F.col("topic"), GPS_TOPICS, strict).alias("city_code"),
        F.when(is_point, part(0)).alias("driver_id"),
        F.coalesce(part(1), F.col("key")).alias("order_id"),
        F.when(is_point, epoch).otherwise(times.to_epoch(F.col("ts"))).alias("epoch"),
        part(3).alias("lng"), part(4).alias("lat"),
        F.when(is_point, F.concat_ws(",", part(3), part(4))).otherwise(value).alias("item"),
        (~is_point).alias("is_end"), "offset",
    ).where(F.col("epoch").isNotNull() & (F.col("is_end") | F.col("lat").isNotNull()))


def gps_points(messages: DataFrame, strict: bool = False) -> DataFrame:
    """Track points with their row key and readable time."""
    points = track_messages(messages.where(F.col("value").contains(",")), strict)
    return points.select(
        F.concat_ws("_", "order_id", F.col("epoch").cast("string")).alias("rowkey"),
        "city_code", "driver_id", "order_id", "epoch",
        times.epoch_to_text(F.col("epoch")).alias("time"), "lng", "lat", "offset")


def track_table(points: DataFrame) -> DataFrame:
    """The stored track: one row per row key, the last written."""
    return latest_per_key(points, ["rowkey"], ["offset"])


def live_orders(points: DataFrame, city: str | None = None) -> DataFrame:
    """Distinct orders with points, as ``<city>_<order>`` keys, optionally of one city."""
    if city:
        points = points.where(F.col("city_code") == city)
    return (points.select("city_code", "order_id").distinct()
            .select(keys.live_key(F.col("city_code"), F.col("order_id")).alias("live_key"),
                    "city_code", "order_id"))


def new_orders(points: DataFrame, known: DataFrame) -> DataFrame:
    """Orders of a batch not among the known ones.

    One aggregation over both sides instead of an anti join: Spark would push that join below the
    distinct, where every point of a long order goes to one task.
    """
    fresh = points.select("city_code", "order_id", F.lit(False).alias("known"))
    seen = known.select("city_code", "order_id", F.lit(True).alias("known"))
    return (fresh.union(seen).groupBy("city_code", "order_id").agg(F.bool_or("known").alias("known"))
            .where(~F.col("known")).drop("known"))


def order_spans(points: DataFrame) -> DataFrame:
    """First and latest point time of each order."""
    return points.groupBy("order_id").agg(
        F.min("epoch").alias("start_epoch"), F.max("epoch").alias("end_epoch"))


def order_lifecycle(tracked: DataFrame) -> DataFrame:
    """Opening, latest and closing state per order; an order opens with its first point."""
    moment = F.when(~F.col("is_end"), F.col("epoch"))
    return (tracked.groupBy("city_code", "order_id")
            .agg(F.min(moment).alias("start_epoch"), F.max(moment).alias("end_epoch"),
                 F.count(moment).alias("points"), F.bool_or("is_end").alias("closed"))
            .where(F.col("start_epoch").isNotNull()))


def first_seen(points: DataFrame) -> DataFrame:
    return points.groupBy("city_code", "order_id").agg(F.min("epoch").alias("first_epoch"))


def hourly_from_first_seen(first: DataFrame) -> DataFrame:
    time = times.epoch_to_text(F.col("first_epoch"))
    return (first.groupBy("city_code", times.day_of(time).alias("day"), times.hour_of(time).alias("hour"))
            .agg(F.count("*").alias("order_count")))


def hourly_orders(points: DataFrame) -> DataFrame:
    """Orders per city, day and hour; each order counts once, in the hour of its first point."""
    return hourly_from_first_seen(first_seen(points))


def _hour_map(hourly: DataFrame) -> DataFrame:
    # At most 24 hours per city and day, so the collected list is bounded.
    return hourly.groupBy("city_code", "day").agg(F.map_from_entries(F.collect_list(F.struct(
        F.concat_ws("_", "city_code", "day", "hour"), F.col("order_count")))).alias("counts"))


def hourly_series(hourly: DataFrame) -> DataFrame:
    """All 24 hours of every city and day, zeros where there was no order."""
    slots = _hour_map(hourly).withColumn(
        "slot", F.explode(F.transform(F.sequence(F.lit(0), F.lit(HOURS - 1)),
                                      lambda h: F.lpad(h.cast("string"), 2, "0"))))
    key = F.concat_ws("_", "city_code", "day", "slot")
    return slots.select("city_code", "day", F.col("slot").alias("hour"),
                        F.coalesce(F.try_element_at("counts", key), F.lit(0)).alias("order_count"))


def hour_count_map(hourly: DataFrame) -> DataFrame:
    """The hourly counts of a city and day as one hash: all fields, their values, one looked up."""
    counts = F.col("counts")
    morning = F.concat_ws("_", "city_code", "day", F.lit("08"))
    return _hour_map(hourly).select(
        "city_code", "day",
        F.array_join(F.array_sort(F.map_keys(counts)), ",").alias("fields"),
        F.aggregate(F.map_values(counts), F.lit(0).cast("bigint"), lambda a, v: a + v).alias("total"),
        F.map_contains_key(counts, morning).alias("has_08"),
        F.try_element_at(counts, morning).alias("at_08"))


ORDER_KEY = ("city_code", "order_id")


def _items(tracked: DataFrame) -> DataFrame:
    return tracked.select(*ORDER_KEY, "epoch", "offset", "item")


def track_replay(tracked: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Items of each order in the order they are replayed, the oldest first, from 1."""
    return number_rows(_items(tracked), ORDER_KEY, ["epoch", "offset"], "seq",
                       rows_per_task=rows_per_task).select(*ORDER_KEY, "seq", "item")


def track_list(tracked: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Items of each order as a list grown at its head: index 0 is the newest.

    Kept as rows rather than an array, since one order may own any share of the points.
    """
    listed = number_rows(_items(tracked), ORDER_KEY, ["-epoch", "-offset"], "_rn", "_n",
                         rows_per_task)
    return listed.select(*ORDER_KEY, (F.col("_rn") - 1).alias("idx"), F.col("_n").alias("length"), "item")


def list_range(listed: DataFrame, start: int, stop: int) -> DataFrame:
    """Rows of a list between two inclusive positions; a negative one counts from the end."""
    def position(p: int) -> Column:
        return F.lit(p) if p >= 0 else F.col("length") + p

    return listed.where(F.col("idx").between(position(start), position(stop)))


def list_index(listed: DataFrame, at: int) -> DataFrame:
    return list_range(listed, at, at)


def list_trim(listed: DataFrame, start: int, stop: int) -> DataFrame:
    """The list cut down to a range, positions counted anew."""
    first = F.lit(start) if start >= 0 else F.greatest(F.col("length") + start, F.lit(0))
    kept = list_range(listed, start, stop).withColumn("idx", F.col("idx") - first)
    last = F.col("length") - 1 if stop == -1 else (
        F.lit(stop) if stop >= 0 else F.col("length") + stop)
    return kept.withColumn("length", F.least(last, F.col("length") - 1) - first + 1)


def track_range(points: DataFrame, order: str, start: int, end: int) -> DataFrame:
    """Points of one order from ``start`` up to but not including ``end``, in time order.

    On a table partitioned by day only the days of the range are read.
    """
    if "day" in points.columns:
        days = [_day_of(F.lit(moment)) for moment in (start, end)]
        points = points.where(F.col("day").between(*days))
    return (points.where((F.col("order_id") == order) & (F.col("epoch") >= start)
                         & (F.col("epoch") < end)).orderBy("epoch", "offset"))


def track_ranges(points: DataFrame, requests: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """:func:`track_range` for a table of requests (order_id, from_epoch, to_epoch), one per order."""
    joined = join_unique(points, requests, ["order_id"], rows_per_task, ["order_id", "epoch", "offset"])
    return _within(joined).select(*points.columns)


def _within(joined: DataFrame) -> DataFrame:
    return joined.where((F.col("epoch") >= F.col("from_epoch")) & (F.col("epoch") < F.col("to_epoch")))


def stored_ranges(track: DataFrame, requests: DataFrame) -> DataFrame:
    """:func:`track_ranges` on a track table stored in buckets of orders, for any number of requests per order.

    Only the requests are shuffled, into the buckets; a bucket's points stream past its requests, so that a long order
    needs no memory, and where the requests are few Spark sends them to the points instead. The days that the requests reach over
    bound the days that are read.
    """
    bounds = requests.agg(F.min("from_epoch").alias("low"), F.max("to_epoch").alias("high"))
    if "day" in track.columns:
        first, last = (bounds.select(_day_of(F.col(side))).scalar() for side in ("low", "high"))
        track = track.where((F.col("day") >= first) & (F.col("day") <= last))
    return _within(track.join(requests, "order_id")).select(*track.columns)


def _day_of(epoch: Column) -> Column:
    return times.day_of(times.epoch_to_text(epoch))


def order_history(points: DataFrame, spans: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Points of each order within its stored span, the end excluded."""
    requests = spans.select("order_id", F.col("start_epoch").alias("from_epoch"),
                            F.col("end_epoch").alias("to_epoch"))
    return track_ranges(points, requests, rows_per_task)


def query_tracks(points: DataFrame, start: str | None = None, end: str | None = None,
                 city: str | None = None) -> DataFrame:
    """Track rows with optional bounds on the time text, both inclusive, and an optional city.

    On a table partitioned by day a bound on the time implies one on its first ten characters, which
    is added so that other days are not read.
    """
    by_day = "day" in points.columns
    if start:
        points = points.where(F.col("time") >= start)
        points = points.where(F.col("day") >= start[:10]) if by_day else points
    if end:
        points = points.where(F.col("time") <= end)
        points = points.where(F.col("day") <= end[:10]) if by_day else points
    if city:
        points = points.where(F.col("city_code") == city)
    return points.select("rowkey", "driver_id", "order_id", "epoch", "time", "lng", "lat")


def query_track_points(points: DataFrame, start: str | None = None, end: str | None = None,
                       city: str | None = None) -> DataFrame:
    return query_tracks(points, start, end, city).select("time", "lng", "lat")


def typed_rows(stored: DataFrame, fields: Sequence[tuple[str, str]]) -> DataFrame:
    """Text columns as typed fields, matched ignoring case; no such column gives null.

    A ``date`` field reads epoch seconds and gives the day.
    """
    by_name = {c.lower(): c for c in stored.columns}
    columns = []
    for name, kind in fields:
        source = by_name.get(name.lower())
        if source is None:
            columns.append(F.lit(None).cast("string" if kind == "date" else kind).alias(name))
        elif kind == "date":
            columns.append(times.day_of(times.epoch_to_text(F.col(source).try_cast("long"))).alias(name))
        else:
            columns.append(F.col(source).try_cast(kind).alias(name))
    return stored.select(*columns)
