"""Order lines: validation, parsing, running totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.constants import HAIKOU, ORDER_LINE_FIELDS, ORDER_TOPICS
from wayfare.functions import keys, text

DATE_PATTERN = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
LINE_FIELDS = len(ORDER_LINE_FIELDS)


def is_data_line(line: Column) -> Column:
    """A line holding a date; headers and blank lines hold none."""
    return F.coalesce(line.rlike(DATE_PATTERN), F.lit(False))


def line_checks(messages: DataFrame) -> DataFrame:
    """Per message: data line, and right number of fields with and without trailing empty ones."""
    value = F.col("value")
    return messages.select(
        "offset", is_data_line(value).alias("is_data"),
        (is_data_line(value) & (F.size(text.fields(value)) == LINE_FIELDS)).alias("stream_valid"),
        (is_data_line(value) & (F.size(text.fields_trimmed(value)) == LINE_FIELDS)).alias("batch_valid"))


def _field(parts: Column, name: str) -> Column:
    return F.get(parts, F.lit(ORDER_LINE_FIELDS.index(name)))


def parse_lines(messages: DataFrame) -> DataFrame:
    """Valid Haikou lines as 26 named fields; the departure day is the day of the order."""
    valid = messages.where(is_data_line(F.col("value"))).select(
        *[c for c in messages.columns if c != "value"], text.fields(F.col("value")).alias("parts")
    ).where(F.size("parts") == LINE_FIELDS)
    parts = F.col("parts")
    return valid.select(
        *[c for c in valid.columns if c != "parts"],
        *[_field(parts, n).alias(n) for n in ORDER_LINE_FIELDS],
        _field(parts, "departure_day").alias("create_day"))


def order_detail(messages: DataFrame) -> DataFrame:
    """Order-detail rows: 24 columns and a row key of order and departure time."""
    valid = messages.where(is_data_line(F.col("value"))).select(
        "offset", text.fields_trimmed(F.col("value")).alias("parts")
    ).where(F.size("parts") == LINE_FIELDS)
    parts = F.col("parts")

    def at(name: str) -> Column:
        return _field(parts, name)

    columns = []
    for name in ORDER_LINE_FIELDS:
        if name in ("arrive_day", "departure_day"):
            event = name.removesuffix("_day")
            columns.append(F.concat_ws(" ", at(name), at(f"{event}_time")).alias(f"{event}_time"))
        elif name not in ("arrive_time", "departure_time"):
            columns.append(at(name).alias("type" if name == "order_time_type" else name))
    rowkey = keys.compact_departure(at("order_id"), at("departure_day"), at("departure_time"))
    return valid.select(rowkey.alias("rowkey"), *columns, "offset")


def city_of_topic(topic: Column, cities: dict[str, str], strict: bool = False) -> Column:
    """City code of a topic, ignoring case; an unknown topic is null, or an error when strict."""
    lowered = F.lower(topic)
    out = F.lit(None).cast("string")
    if strict:
        out = F.raise_error(F.concat(topic, F.lit(" is not a known topic"))).cast("string")
    for name, city in cities.items():
        out = F.when(lowered == name, F.lit(city)).otherwise(out)
    return out


def parse_by_topic(messages: DataFrame) -> DataFrame:
    """Each order message by the parser of its topic; ``city_code`` is null where nothing parses.

    Haikou lines carry day and passengers; the comma-separated cities only an order id, so their
    day is empty and a trip counts one passenger.
    """
    value = F.col("value")
    # Topic names are exact here, unlike those of the GPS consumers.
    city = F.lit(None).cast("string")
    for name, code in ORDER_TOPICS.items():
        city = F.when(F.col("topic") == name, F.lit(code)).otherwise(city)
    parts = text.fields(value)
    haikou_ok = is_data_line(value) & (F.size(parts) == LINE_FIELDS)
    is_haikou = city == HAIKOU
    parsed = city.isNotNull() & (~is_haikou | haikou_ok)
    riders = _field(parts, "passenger_count").try_cast("int")
    return messages.select(
        *[c for c in messages.columns if c != "value"],
        F.when(parsed, city).alias("city_code"),
        F.when(parsed, F.when(is_haikou, parts[0]).otherwise(
            F.get(text.fields(value, ","), F.lit(0)))).alias("order_id"),
        F.when(parsed, F.when(is_haikou, _field(parts, "departure_day")).otherwise(F.lit(""))
               ).alias("create_day"),
        F.when(parsed, F.when(is_haikou & (riders > 0), riders).otherwise(F.lit(1))).alias("passengers"))


def order_totals(messages: DataFrame) -> DataFrame:
    """Orders and passengers per city and day. As a stream these are the running totals."""
    return (parse_by_topic(messages).where(F.col("city_code").isNotNull())
            .groupBy("city_code", "create_day")
            .agg(F.count("*").alias("order_count"), F.sum("passengers").alias("passenger_count")))


def order_counts(messages: DataFrame) -> DataFrame:
    return order_totals(messages).select(
        F.concat_ws("_", "city_code", "create_day").alias("city_day"), "order_count")


def passenger_counts(messages: DataFrame) -> DataFrame:
    return order_totals(messages).select(
        F.concat_ws("_", "city_code", "create_day").alias("city_day"), "passenger_count")


def reject_count(messages: DataFrame) -> DataFrame:
    """Messages no parser accepted, per topic."""
    return (parse_by_topic(messages).where(F.col("city_code").isNull())
            .groupBy("topic").agg(F.count("*").alias("rejected")))


def order_overview(totals: DataFrame, hourly: DataFrame) -> DataFrame:
    """Order and passenger count per city and day.

    The sum of the hourly counts stands for the orders when it is above zero, else the running
    counter; a day without passengers shows 0. Both inputs are already one row per city and day or
    hour, and are combined by one aggregation instead of an outer join.
    """
    counters = totals.select(
        "city_code", F.col("create_day").alias("day"), "order_count", "passenger_count",
        F.lit(None).cast("bigint").alias("hour_orders"))
    hours = hourly.select(
        "city_code", "day", F.lit(None).cast("bigint").alias("order_count"),
        F.lit(None).cast("bigint").alias("passenger_count"), F.col("order_count").alias("hour_orders"))
    return (counters.unionByName(hours).groupBy("city_code", "day")
            .agg(F.coalesce(F.nullif(F.sum("hour_orders"), F.lit(0)), F.sum("order_count"))
                 .alias("order_count"),
                 F.coalesce(F.sum("passenger_count"), F.lit(0)).alias("passenger_count")))
