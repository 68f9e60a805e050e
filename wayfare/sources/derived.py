"""Ride-hailing inputs derived row by row from the star-schema tables.

Every frame here is a projection of (or a union over) whole tables, so the inputs grow with them.
Coordinates are composed from integer micro-degrees: text of floating numbers differs by engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.constants import ALLIANCE_TABLE, DRIVER_TABLE, GAUGES, ORDER_TABLE, USER_TABLE
from wayfare.functions.times import to_epoch
from wayfare.sources.tables import table


def _text(c: Column) -> Column:
    return c.cast("string")


def _pad(c: Column, width: int) -> Column:
    return F.lpad(_text(c), width, "0")


def _degrees(micro: Column) -> Column:
    return F.concat(_text(F.floor(micro / F.lit(1000000)).cast("long")), F.lit("."),
                    _pad(micro % 1000000, 6))


def _pick(index: Column, *values: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _settled(rows: DataFrame) -> DataFrame:
    """Rows as a source would deliver them: each column is computed once.

    Columns of a generator are not inlined into the expressions above it, whereas those of a plain
    projection would be computed again in every filter and field that uses them.
    """
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def orders_raw(spark: SparkSession, folder: str) -> DataFrame:
    """One ride order per row of ``orders``."""
    return _orders_raw(table(spark, folder, "orders"))


def _orders_raw(o: DataFrame) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    lng = 110200000 + (cust % 10) * 40000 + (key % 3) * 4
    lat = 19800000 + (cust % 6) * 50000 + (key % 2) * 4
    return o.select(
        key.alias("offset"),
        _text(key).alias("order_id"),
        _pick(key % 3, "hai_kou_order_topic", "cheng_du_order_topic", "xi_an_order_topic").alias("topic"),
        _pick(key % 3, "83", "28", "29").alias("city_id"),
        _degrees(lng).alias("starting_lng"),
        _degrees(lat).alias("starting_lat"),
        _text(cust % 5).alias("passenger_count"),
        F.substring(_text(F.col("o_orderdate")), 1, 10).alias("departure_day"),
        F.concat(_pad(key % 24, 2), F.lit(":"), _pad(cust % 60, 2), F.lit(":00")).alias("departure_time"))


def order_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines of three cities as messages, with headers, short lines and odd trailing fields."""
    o = _orders_raw(table(spark, folder, "orders"))
    key, day, time = F.col("offset"), F.col("departure_day"), F.col("departure_time")
    csv = F.concat_ws(",", "order_id", "starting_lng", "starting_lat")
    # Every 41st order carries a passenger count that is no number.
    pax = F.when(key % 41 == 0, F.lit("x")).otherwise(F.col("passenger_count"))
    # Every 31st line ends with an empty day of month; every 29th has one blank too many.
    last = F.when(key % 31 == 0, F.lit("")).otherwise(F.substring(day, 9, 2))
    extra = F.when(key % 29 == 0, F.lit(" ")).otherwise(F.lit(""))
    line = F.concat(F.concat_ws(
        " ", F.col("order_id"), F.lit("3"), F.col("city_id"), F.lit("0898 460107 0 0 0"), pax,
        F.lit("3 4361"), day, time, day, time, F.lit("13 11"), F.concat(F.lit("b"), F.col("order_id")),
        F.lit("3 110.3645 20.0353"), F.col("starting_lng"), F.col("starting_lat"),
        F.substring(day, 1, 4), F.substring(day, 6, 2), last), extra)
    value = (F.when(key % 50 == 0, F.lit("order_id product_id city_id"))
             .when(F.col("topic") != "hai_kou_order_topic", csv)
             .when(key % 33 == 0, F.concat_ws(" ", F.col("order_id"), F.lit("3"), day, time))
             .otherwise(line))
    # Every 53rd message comes from a topic nobody parses.
    topic = F.when(key % 53 == 0, F.lit("unknown_topic")).otherwise(F.col("topic"))
    return _settled(o.select(topic.alias("topic"), F.col("order_id").alias("key"), value.alias("value"),
                             key.alias("offset")))


def gps_messages(spark: SparkSession, folder: str) -> DataFrame:
    """GPS points, end markers and noise, one message per row of ``events``."""
    e = table(spark, folder, "events")
    ident, user = F.col("event_id"), F.col("user_id")
    order = F.concat(F.lit("o"), _text(user), F.lit("d"), F.substring(_text(F.col("ts")), 9, 2))
    point = F.concat_ws(
        ",", F.concat(F.lit("d"), _text(user)), order, _text(to_epoch(F.col("ts"))),
        F.concat(F.lit("104."), _pad(50000 + ident % 40000, 6)),
        F.concat(F.lit("30."), _pad(600000 + (ident * 7) % 60000, 6)))
    value = (F.when(F.col("event_type") == "error", F.lit("end"))
             .when(F.col("event_type") == "signup", F.lit("noise"))
             .otherwise(point))
    return _settled(e.select(
        _pick(user % 2, "cheng_du_gps_topic_2", "xi_an_gps_topic").alias("topic"),
        order.alias("key"), value.alias("value"), ident.alias("offset"), F.col("ts").alias("ts")))


def _envelope(tbl: Column, op: Column, data: Column, offset: Column) -> list[Column]:
    return [F.to_json(F.struct(tbl.alias("table"), op.alias("type"), data.alias("data"))).alias("value"),
            offset.alias("offset")]


def order_changes(spark: SparkSession, folder: str) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    created = F.concat(F.lit("2017-05-"), _pad(cust % 28 + 1, 2), F.lit(" "), _pad(cust % 24, 2),
                       F.lit(":00:00"))
    data = F.struct(
        F.when(key % 97 != 0, _text(cust)).alias("id_"),
        F.when(cust % 43 != 0, created).alias("create_time"),
        F.col("o_orderstatus").alias("state"),
        F.col("o_orderpriority").alias("order_type"),
        _text(key).alias("pay_time"))
    tbl = F.when(key % 4 == 0, F.lit(ORDER_TABLE + "_a")).otherwise(F.lit(ORDER_TABLE))
    op = (F.when(key % 5 == 0, F.lit("delete")).when(key % 5 == 1, F.lit("update"))
          .otherwise(F.lit("insert")))
    return table(spark, folder, "orders").select(*_envelope(tbl, op, data, key))


def user_changes(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    day = F.concat(F.lit("2018-03-"), _pad(key % 28 + 1, 2))
    data = F.struct(
        _text(key).alias("id_"),
        F.when(key % 3 != 0, F.concat(day, F.lit(" 09:15:00"))).alias("create_time"),
        F.concat(F.lit("NATION_"), _text(F.col("c_nationkey"))).alias("last_login_city"),
        F.when(key % 5 != 0, F.concat(day, F.lit(" 10:30:00"))).alias("last_logon_time"),
        F.col("c_mktsegment").alias("city_name"))
    op = F.when(key % 7 != 0, F.lit("update"))
    return table(spark, folder, "customer").select(*_envelope(F.lit(USER_TABLE), op, data, key))


def driver_changes(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    data = F.struct(
        _text(key).alias("id_"),
        F.concat(F.lit("2019-01-"), _pad(key % 28 + 1, 2), F.lit(" 07:00:00")).alias("create_time"),
        F.concat(F.lit("NATION_"), _text(F.col("s_nationkey"))).alias("register_city"),
        F.col("s_name").alias("driver_name"),
        _text(key % 4).alias("cancel_count"))
    return table(spark, folder, "supplier").select(
        *_envelope(F.lit(DRIVER_TABLE), F.lit("insert"), data, key))


def alliance_changes(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("n_nationkey").cast("long")
    data = F.struct(
        _text(key).alias("id_"),
        F.col("n_name").alias("alliance_name"),
        F.when(key % 2 == 0, F.concat(F.lit("p"), _text(key))).alias("linkman"),
        F.when(key % 4 != 0, F.lit("2016-02-03 04:05:06")).alias("create_time"),
        F.lit("2016-07-08 09:10:11").alias("update_time"),
        F.lit("0").alias("state"))
    return table(spark, folder, "nation").select(
        *_envelope(F.lit(ALLIANCE_TABLE), F.lit("insert"), data, key))


def alliance_updates(spark: SparkSession, folder: str) -> DataFrame:
    """Four writes per alliance and row key: an insert, two updates of some cells, and for some a delete or a last name."""
    key = F.col("n_nationkey").cast("long")
    write = F.col("write")

    def at(n: int, value: Column) -> Column:
        return F.when(write == n, value)

    data = F.struct(
        _text(key).alias("id_"),
        F.coalesce(at(0, F.col("n_name")), at(3, F.when(key % 5 == 0, F.concat(F.col("n_name"), F.lit(" 2")))))
        .alias("alliance_name"),
        F.coalesce(at(0, F.when(key % 2 == 0, F.concat(F.lit("p"), _text(key)))),
                   at(1, F.when(key % 3 == 0, F.concat(F.lit("q"), _text(key))))).alias("linkman"),
        F.lit("2016-02-03 04:05:06").alias("create_time"),
        F.coalesce(at(1, F.lit("2016-07-08 09:10:11")), at(2, F.lit("2016-08-08 09:10:11"))).alias("update_time"),
        F.coalesce(at(0, F.lit("0")), at(2, F.when(key % 4 != 0, F.lit("1")))).alias("state"))
    op = (F.when(write == 0, F.lit("insert")).when((write == 3) & (key % 7 == 0), F.lit("delete"))
          .otherwise(F.lit("update")))
    writes = table(spark, folder, "nation").select("*", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("write"))
    return _settled(writes.select(*_envelope(F.lit(ALLIANCE_TABLE), op, data, write * 1000 + key)))


def unrouted_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Records of tables nobody handles; every second one names no table at all."""
    key = F.col("p_partkey")
    tbl = F.when(key % 2 == 0, F.lit("unknown_table"))
    return table(spark, folder, "part").select(
        *_envelope(tbl, F.lit("insert"), F.struct(_text(key).alias("id_")), key))


def change_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The change records of all tables in one stream of messages."""
    return _settled(order_changes(spark, folder)
                    .unionByName(user_changes(spark, folder))
                    .unionByName(driver_changes(spark, folder))
                    .unionByName(alliance_changes(spark, folder))
                    .unionByName(unrouted_changes(spark, folder)))


def supplier_polygons(spark: SparkSession, folder: str) -> DataFrame:
    """A closed five-point district ring per supplier; every seventh has none."""
    key = F.col("s_suppkey")
    west, south = 110000000 + (key % 50) * 12000, 19000000 + (key % 30) * 15000
    east, north = west + 10000 + key % 7 * 1000, south + 9000 + key % 5 * 1000

    def corner(lng: Column, lat: Column) -> Column:
        return F.concat_ws(",", _degrees(lng), _degrees(lat))

    ring = F.concat_ws(";", corner(west, south), corner(east, south), corner(east, north),
                       corner(west, north), corner(west, south))
    return table(spark, folder, "supplier").select(
        key.alias("supplier"),
        F.concat(F.lit("d"), _text(key)).alias("name"),
        F.concat(F.lit("0"), _text(F.col("s_nationkey"))).alias("citycode"),
        F.when(key % 7 != 0, ring).otherwise(F.lit("")).alias("polygon"))


def customer_points(spark: SparkSession, folder: str) -> DataFrame:
    """A pickup per customer in the part of the world where the suppliers' districts are; a tenth share one spot, some lie on borders."""
    key = F.col("c_custkey")
    spread = F.when(key % 10 == 0, F.lit(25)).otherwise(key)
    return table(spark, folder, "customer").select(
        _text(key).alias("order_id"), _degrees(110000000 + spread * 7919 % 600 * 1000).alias("starting_lng"),
        _degrees(19000000 + spread * 104729 % 460 * 1000).alias("starting_lat"))


def district_documents(spark: SparkSession, folder: str) -> DataFrame:
    """A city document per supplier listing four districts; the city code wanted comes with it."""
    p = supplier_polygons(spark, folder)

    def leaf(suffix: str, code: Column, polygon: Column) -> Column:
        return F.struct(F.concat(F.col("name"), F.lit(suffix)).alias("name"), code.alias("citycode"),
                        polygon.alias("polyline"), F.lit("district").alias("level"))

    wanted, ring = F.col("citycode"), F.col("polygon")
    children = F.array(leaf("-x", F.lit("999"), ring), leaf("-a", wanted, ring),
                       leaf("-b", wanted, F.lit("1,1;2,1;2,2;1,1")), leaf("-y", F.lit("998"), ring))
    city = F.struct(F.lit("city").alias("name"), wanted.alias("citycode"), F.lit("city").alias("level"),
                    children.alias("districts"))
    return p.select(wanted.alias("wanted"),
                    F.to_json(F.struct(F.array(city).alias("districts"))).alias("document"))


def geojson_documents(spark: SparkSession, folder: str) -> DataFrame:
    """A feature collection per supplier: one multipolygon holding two triangles."""
    key = F.col("s_suppkey")

    def triangle(shift: int) -> Column:
        x, y = (key % 90 + shift).cast("double"), (key % 45).cast("double")
        points = [F.array(x, y), F.array(x + 0.5, y), F.array(x, y + 0.25), F.array(x, y)]
        return F.array(F.array(*points))

    feature = F.struct(
        F.struct(F.col("s_name").alias("name")).alias("properties"),
        F.struct(F.lit("MultiPolygon").alias("type"),
                 F.array(triangle(0), triangle(1)).alias("coordinates")).alias("geometry"))
    return table(spark, folder, "supplier").select(
        F.to_json(F.struct(F.array(feature).alias("features"))).alias("document"))


def gauge_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """A metrics snapshot per event: every gauge holds the event id plus its place in the list."""
    ident = F.col("event_id")
    pairs = []
    for place, path in enumerate(GAUGES.values()):
        # The fourth gauge is missing from every tenth snapshot.
        key = F.lit(f"app.{path}") if place != 3 else F.concat(
            F.lit(f"app.{path}"), F.when(ident % 10 == 0, F.lit(".absent")).otherwise(F.lit("")))
        pairs += [key, F.struct((ident + place).alias("value"))]
    return table(spark, folder, "events").select(
        ident.alias("snapshot"), F.to_json(F.struct(F.create_map(*pairs).alias("gauges"))).alias("value"))


def _block(name: Column, number: int, size: Column) -> Column:
    level = F.struct(F.lit(number == 1).alias("Use Disk"), F.lit(number == 0).alias("Use Memory"))
    status = F.struct(level.alias("Storage Level"), (size * 10 if number == 0 else F.lit(0)).cast("long").alias("Memory Size"),
                      (size * 20 if number == 1 else F.lit(0)).cast("long").alias("Disk Size"))
    return F.struct(name.alias("Block ID"), status.alias("Status"))


def task_events(spark: SparkSession, folder: str) -> DataFrame:
    """An event-log line per row of ``lineitem``: mostly task ends, some failed or killed."""
    order, line = F.col("l_orderkey"), F.col("l_linenumber").cast("long")
    size = F.col("l_quantity").cast("long")
    reason = (F.when(line == 3, F.struct(F.lit("ExceptionFailure").alias("Reason"),
                                         F.lit(None).cast("string").alias("Kill Reason"),
                                         F.lit("java.io.IOException").alias("Class Name"),
                                         F.concat(F.lit("disk "), _text(order)).alias("Description")))
              .when(line == 5, F.struct(F.lit("TaskKilled").alias("Reason"),
                                        F.lit("another attempt succeeded").alias("Kill Reason"),
                                        F.lit(None).cast("string").alias("Class Name"),
                                        F.lit(None).cast("string").alias("Description")))
              .otherwise(F.struct(F.lit("Success").alias("Reason"),
                                  F.lit(None).cast("string").alias("Kill Reason"),
                                  F.lit(None).cast("string").alias("Class Name"),
                                  F.lit(None).cast("string").alias("Description"))))
    info = F.struct(
        (order * 8 + line).alias("Task ID"),
        F.concat(F.lit("h"), _text(F.col("l_suppkey"))).alias("Host"),
        (line == 2).alias("Speculative"), (line == 3).alias("Failed"), (line == 5).alias("Killed"),
        F.lit(1700000000000).alias("Finish Time"))
    metrics = F.struct(
        *[(size + i).alias(n) for i, n in enumerate((
            "Executor Deserialize Time", "Executor Deserialize CPU Time", "Executor Run Time",
            "Executor CPU Time", "Result Size", "JVM GC Time", "Result Serialization Time",
            "Memory Bytes Spilled", "Disk Bytes Spilled", "Peak Execution Memory"))],
        F.struct(*[(size * (i + 2)).alias(n) for i, n in enumerate((
            "Remote Blocks Fetched", "Local Blocks Fetched", "Remote Bytes Read", "Local Bytes Read",
            "Fetch Wait Time", "Total Records Read"))]).alias("Shuffle Read Metrics"),
        F.struct(*[(size * (i + 11)).alias(n) for i, n in enumerate((
            "Shuffle Bytes Written", "Shuffle Records Written", "Shuffle Write Time"))]
        ).alias("Shuffle Write Metrics"),
        F.struct(F.col("l_partkey").alias("Bytes Read"), size.alias("Records Read")).alias("Input Metrics"),
        F.struct((F.col("l_partkey") * 2).alias("Bytes Written"),
                 (size * 2).alias("Records Written")).alias("Output Metrics"),
        # As many blocks as the line's number leaves when divided by three.
        F.slice(F.array(*[_block(F.concat(F.lit("rdd_"), _text(order % 100), F.lit(f"_{i}")), i, size) for i in range(2)]),
                F.lit(1), (line % 3).cast("int")).alias("Updated Blocks"))
    event = F.when(line == 7, F.lit("SparkListenerTaskStart")).otherwise(F.lit("SparkListenerTaskEnd"))
    return table(spark, folder, "lineitem").select(F.to_json(F.struct(
        event.alias("Event"), (order % 100).alias("Stage ID"), F.lit(0).alias("Stage Attempt ID"),
        reason.alias("Task End Reason"), info.alias("Task Info"), metrics.alias("Task Metrics"),
    )).alias("value"))


def batch_reports(spark: SparkSession, folder: str) -> DataFrame:
    """A finished micro-batch per hour of ``events``."""
    e = table(spark, folder, "events")
    second = to_epoch(F.col("ts"))
    return (e.groupBy(F.floor(second / F.lit(3600)).alias("batch_id"))
            .agg(F.count("*").alias("records"), (F.min(second) * 1000).alias("start_ms"),
                 (F.max(second) * 1000).alias("end_ms")))


def batch_delays(spark: SparkSession, folder: str) -> DataFrame:
    """A one-second micro-batch per event with its total delay."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("batch_id"), (F.col("event_id") % 20 * 1000).alias("total_delay_ms"))


def increments(spark: SparkSession, folder: str) -> DataFrame:
    """Counter increments: key = event type, field = user, delta = value in cents."""
    return table(spark, folder, "events").select(
        F.col("event_type").alias("key"), F.col("user_id").alias("field"),
        F.round(F.col("value") * 100).cast("long").alias("delta"))


def set_members(spark: SparkSession, folder: str) -> DataFrame:
    """Keyed sets: the users seen per event type and day."""
    return table(spark, folder, "events").select(
        F.concat_ws("_", F.col("event_type"), F.substring(_text(F.col("ts")), 1, 10)).alias("key"),
        F.col("user_id").alias("member"))
