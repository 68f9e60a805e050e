"""Stations: districts by both join ways, representatives, readers."""

import json
import random

from pyspark.sql import functions as F

from wayfare.operators import metrics, stations, tracks
from wayfare.operators.spread import cut_pieces
from wayfare.plans.catalog import DISTRICTS
from wayfare.schemas import DISTRICT_DOCUMENT
from wayfare.sources import derived, sinks, tables

SF = "/root/testdata/sf0.001"


def inside(px, py, ring):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if ((x2 - x1) * (py - y1) == (y2 - y1) * (px - x1) and min(x1, x2) <= px <= max(x1, x2)
                and min(y1, y2) <= py <= max(y1, y2)):
            return False
        if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def random_districts(rng, n):
    rows = []
    for i in range(n):
        x, y, size = rng.uniform(110, 111), rng.uniform(19, 20), rng.choice([0.01, 0.1, 0.7])
        ring = [(x, y), (x + size, y + rng.uniform(0, size / 3)), (x + size / 2, y + size / 2),
                (x + size, y + size), (x, y + size), (x, y)]
        rows.append((f"d{i}", "0", ";".join(f"{a:.6f},{b:.6f}" for a, b in ring)))
    return rows


def test_both_district_joins_match_brute_force(spark):
    rng = random.Random(11)
    rows = random_districts(rng, 60) + DISTRICTS
    points = [(str(i), f"{rng.uniform(110, 111.5):.6f}", f"{rng.uniform(19, 20.5):.6f}") for i in range(400)]
    # Corners and edge points of the first shapes.
    points += [(f"c{i}", *p.split(",")) for i, p in enumerate(rows[0][2].split(";"))]
    points += [("e1", "110.32", "19.90"), ("e2", "110.25", "19.79"), ("bad", "x", "1")]
    frame = spark.createDataFrame(points, "order_id string, starting_lng string, starting_lat string")
    districts = stations.district_table(spark, rows)
    rings = {n: [tuple(map(float, p.split(","))) for p in g.split(";")] for n, _, g in rows if g}
    want = sorted((o, n) for o, x, y in points if x != "x" for n, ring in rings.items()
                  if inside(float(x), float(y), ring))
    got = stations.label_districts(frame, districts)
    assert sorted((r["order_id"], r["district_name"]) for r in got.collect()) == want
    assert want
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_representative_is_the_first_as_text(spark):
    data = [("2", "83", "110.2", "19.8"), ("1", "83", "110.20", "19.8"), ("3", "83", "110.2", "19.80"),
            ("0", "83", "110.20", "19.8"), ("9", "83", "x", "19.8")]
    orders = spark.createDataFrame(data, "order_id string, city_id string, starting_lng string, starting_lat string")
    row, = stations.cell_representatives(stations.grid_cells(orders)).collect()
    assert (row["order_count"], row["order_id"]) == (4, "2")


def test_every_station_cell_is_hot(spark):
    orders = tables.order_scan(derived.orders_raw(spark, SF))
    gridded = stations.grid_cells(orders)
    table = stations.stations(orders, stations.district_table(spark, DISTRICTS))
    counts = table.join(gridded.select("order_id", "cell"), "order_id").join(
        gridded.groupBy("cell").count(), "cell")
    assert counts.count() == table.count() > 0
    assert counts.agg(F.min("count")).first()[0] >= 10


def test_later_listed_district_wins_and_table_is_replaced(spark, tmp_path):
    orders = tables.order_scan(derived.orders_raw(spark, SF))
    districts = stations.district_table(spark, DISTRICTS)
    table = stations.stations(orders, districts)
    path = str(tmp_path / "stations")
    sinks.replace_stations(table, path)
    sinks.replace_stations(table, path)
    saved = spark.read.parquet(path)
    assert saved.count() == table.count() == saved.select("order_id").distinct().count()
    assert {r["district_name"] for r in saved.collect()} == {"west", "middle", "south", "notch"}


def test_scan_reads_only_what_it_needs(spark):
    plan = tables.order_scan(derived.orders_raw(spark, SF))._jdf.queryExecution().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_order_store_pruned(spark, tmp_path):
    path = str(tmp_path / "store")
    tables.order_scan(derived.orders_raw(spark, SF)).withColumn("extra", F.lit("x")).write.parquet(path)
    store = tables.order_store(spark, path)
    assert store.columns == ["order_id", "city_id", "starting_lng", "starting_lat"] and store.count() == 1500


def document(*nodes):
    return json.dumps({"districts": list(nodes)})


def leaf(name, code, polyline="1,1;2,2;1,1"):
    return {"name": name, "citycode": code, "level": "district", "polyline": polyline}


def test_district_walk(spark):
    city = {"name": "c", "citycode": "1", "level": "city",
            "districts": [leaf("a", "2"), leaf("b", "1"), leaf("c", "1")]}
    cases = [
        (None, document(city, leaf("d", "9", None)), {"a", "b", "c"}),
        ("1", document(city), {"b"}),
        ("1", document(leaf("x", "1"), leaf("y", "1"), city), {"x"}),
        ("1", document(city, leaf("x", "1"), leaf("y", "1")), {"b", "x"}),
        ("7", document(city), set()),
    ]
    for wanted, text, names in cases:
        docs = spark.createDataFrame([(wanted, text)], "wanted string, document string").withColumn(
            "document", F.from_json("document", DISTRICT_DOCUMENT))
        assert {r["name"] for r in stations.district_rows(docs).collect()} == names


def test_geojson_file(spark, tmp_path):
    path = tmp_path / "map.json"
    ring = [[[[0, 0], [1, 0], [1, 1], [0, 0]]], [[[5, 5], [6, 5], [5, 6], [5, 5]]]]
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"name": "n"},
         "geometry": {"type": "MultiPolygon", "coordinates": ring}}]}, indent=1))
    rows = stations.geojson_rings(tables.geojson(spark, str(path))).collect()
    assert [(r["name"], r["polygon_no"], len(r["points"])) for r in rows] == [("n", 0, 4), ("n", 1, 4)]


def test_optional_station_predicates(spark):
    table = spark.createDataFrame([("1", "83", "1", "2", "west"), ("2", "28", "1", "2", "south")],
                                  "order_id string, city_id string, starting_lng string, "
                                  "starting_lat string, district_name string")
    assert stations.query_stations(table).count() == 2
    assert stations.query_stations(table, "", None).count() == 2
    assert stations.query_stations(table, "83").count() == 1
    assert stations.query_stations(table, "83", "south").count() == 0


def test_event_log_file(spark, tmp_path):
    log = tmp_path / "log"
    log.write_text("\n".join(json.dumps(e) for e in [
        {"Event": "SparkListenerJobStart", "Job ID": 1},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 1, "Stage Attempt ID": 0,
         "Task End Reason": {"Reason": "ExceptionFailure", "Class Name": "E", "Description": "why"},
         "Task Info": {"Task ID": 4, "Host": "h", "Speculative": False, "Failed": True, "Killed": False,
                       "Finish Time": 5},
         "Task Metrics": {"Executor Run Time": 12, "Shuffle Write Metrics": {"Shuffle Bytes Written": 3}}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 1, "Stage Attempt ID": -1,
         "Task End Reason": {"Reason": "Resubmitted"}, "Task Info": {"Task ID": 5}}]))
    events = tables.event_log(spark, str(log))
    assert [tuple(r) for r in metrics.failed_tasks(events).collect()] == [(4, "ExceptionFailure", "E: why")]
    assert metrics.task_metrics(events).where("task_id = 4").first()["run_time"] == 12
    assert metrics.shuffle_metrics(events).where("task_id = 4").first()["bytes_written"] == 3
    assert [r["running"] for r in metrics.task_info(events).orderBy("task_id").collect()] == [False, True]


def test_written_layouts(spark, tmp_path):
    from wayfare.operators import changes, orders, tracks
    points = tracks.gps_points(derived.gps_messages(spark, SF))
    sinks.write_tracks(points, str(tmp_path / "tracks"))
    stored = sinks.read_tracks(spark, str(tmp_path / "tracks"))
    assert stored.count() == points.count()
    for start, end, city in (("2024-01-05 06:00:00", "2024-01-09 18:00:00", "610100"),
                             (None, "2024-01-09", None), ("2024-01-21 10", "", "510100")):
        asked = tracks.query_tracks(stored, start, end, city)
        assert sorted(asked.collect()) == sorted(tracks.query_tracks(points, start, end, city).collect())
    plan = tracks.query_tracks(stored, "2024-01-05 06:00:00", None, "610100")._jdf.queryExecution().toString()
    assert "day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    order, low, high = points.groupBy("order_id").agg(F.min("epoch"), F.max("epoch")).orderBy("order_id").first()
    columns = ["rowkey", "epoch", "offset"]
    assert (tracks.track_range(stored, order, low, high).select(*columns).collect()
            == tracks.track_range(points, order, low, high).select(*columns).collect())
    writes = changes.latest_state(derived.change_messages(spark, SF), "order")
    sinks.write_salted(writes, str(tmp_path / "salted"))
    saved = spark.read.option("inferSchema", "false").parquet(str(tmp_path / "salted"))
    assert saved.count() == writes.count() and saved.select("bucket").distinct().count() <= 9
    detail = orders.order_detail(derived.order_messages(spark, SF))
    sinks.write_order_detail(detail, str(tmp_path / "detail"))
    assert spark.read.parquet(str(tmp_path / "detail")).count() == detail.select("rowkey").distinct().count()


def test_snapshots_expire(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    sinks.append_snapshots(spark.range(3), path)
    sinks.append_snapshots(spark.range(2), path)
    stored = spark.read.parquet(path)
    newest = stored.agg(F.max("captured_at").cast("string")).first()[0]
    moment = F.expr(f"timestamp_ntz'{newest}'")
    assert metrics.retained(stored, moment).count() == 5
    later = F.timestamp_add("SECOND", F.lit(3601), moment)
    assert metrics.retained(stored, later, 3600).count() == 0


def test_hourly_counts_add_up_to_the_orders(spark):
    from wayfare.operators import tracks
    points = tracks.gps_points(derived.gps_messages(spark, SF))
    total = tracks.hourly_orders(points).agg(F.sum("order_count")).first()[0]
    assert total == tracks.live_orders(points).count()
    series = tracks.hourly_series(tracks.hourly_orders(points))
    assert series.groupBy("city_code", "day").count().where("count <> 24").count() == 0
    assert series.agg(F.sum("order_count")).first()[0] == total


def test_one_crowded_district(spark):
    """Most points lie in one district: its tile is cut, and districts of very unlike extents are all found."""
    data = [(str(i), f"110.{200000 + i % 997:06d}" if i % 20 else f"{100 + i % 17}.5", f"19.{800000 + i % 991:06d}" if i % 20 else "20.25")
            for i in range(8000)]
    points = spark.createDataFrame(data, "order_id string, starting_lng string, starting_lat string").repartition(6)
    districts = stations.district_table(spark, [
        ("spot", "1", "110.19,19.79;110.21,19.79;110.21,19.81;110.19,19.81;110.19,19.79"),
        ("land", "1", "99,10;130,10;130,30;99,30;99,10"), ("dot", "1", "110.2,19.8;110.2001,19.8;110.2001,19.8001;110.2,19.8001;110.2,19.8")])
    want = sorted((o, d) for o, x, y in data for d, w, e, s, n in (
        ("spot", 110.19, 110.21, 19.79, 19.81), ("land", 99, 130, 10, 30), ("dot", 110.2, 110.2001, 19.8, 19.8001))
        if w < float(x) < e and s < float(y) < n)
    for limit in (100, 10_000_000):
        got = stations.label_districts(points, districts, rows_per_task=limit)
        assert sorted((r["order_id"], r["district_name"]) for r in got.collect()) == want
    located = points.selectExpr("*", "double(starting_lng) AS _lng", "double(starting_lat) AS _lat")
    _, looked_up = stations.district_tiles(located, stations.district_edges(districts))
    assert looked_up.count() == 3 * len(data)  # three sizes are in use
    crowded = looked_up.groupBy(*stations.TILE).count().agg(F.max("count")).first()[0]
    cut = cut_pieces(looked_up, stations.TILE, 100).groupBy(*stations.TILE, "_piece").count().agg(F.max("count")).first()[0]
    assert crowded > 7000 and cut < crowded / 8


def scans(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan, [line for line in plan.splitlines() if "FileScan" in line]


def test_ranges_of_a_stored_track(spark, tmp_path):
    """Joins by order shuffle no stored rows; one order reads one bucket; days out of reach are not read."""
    points = tracks.gps_points(derived.gps_messages(spark, "/root/testdata/sf0.001"))
    sinks.save_track_table(points, "stored_track", 8, str(tmp_path / "track"))
    try:
        track = spark.table("stored_track")
        assert track.count() == points.count()
        spans = tracks.order_spans(points).selectExpr("order_id", "start_epoch AS from_epoch", "end_epoch AS to_epoch")
        columns = ["rowkey", "order_id", "epoch", "offset"]
        want = sorted(map(tuple, tracks.track_ranges(points, spans).select(*columns).collect()))
        # Requests too many to be sent around, which come in from elsewhere.
        spans.write.parquet(str(tmp_path / "spans"))
        requests = spark.read.parquet(str(tmp_path / "spans"))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        frame = tracks.stored_ranges(track, requests).select(*columns)
        plan, _ = scans(frame)
        assert sorted(map(tuple, frame.collect())) == want
        assert "SortMergeJoin" in plan and "Bucketed: true" in plan
        stored = plan[:plan.index("Bucketed: true")].rsplit("SortMergeJoin", 1)[-1]
        assert "Exchange" not in stored, plan
        order = points.select("order_id").first()[0]
        # The plan names the buckets only where it reads a partition for each; files of others are left out either way.
        spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
        one, _ = scans(tracks.track_range(track, order, 0, 2**40))
        assert "SelectedBucketsCount: 1 out of 8" in one and "PartitionFilters: [isnotnull(day" in one, one[-900:]
        late = requests.groupBy().agg(F.max("to_epoch")).first()[0]
        few = tracks.stored_ranges(track, requests.where(F.col("from_epoch") > late - 86400)).select(*columns)
        assert sorted(map(tuple, few.collect())) == sorted(
            map(tuple, tracks.track_ranges(points, spans.where(F.col("from_epoch") > late - 86400)).select(*columns).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
        spark.sql("DROP TABLE IF EXISTS stored_track")


def test_districts_that_crowd_with_points_are_shared_out(spark, monkeypatch):
    """The work of one tile, points times districts, is cut on both sides and dealt over tasks that are not merged again."""
    monkeypatch.setattr(stations, "PAIRS_PER_TASK", 1 << 10, raising=False)
    monkeypatch.setattr(stations, "SIDE", 1 << 4, raising=False)
    for n_points, n_districts in ((900, 40), (3, 2000)):
        data = [(str(i), "110.205", "19.805") for i in range(n_points)] + [(None, None, "1"), ("0", "110.205", "19.805")]
        points = spark.createDataFrame(data, "order_id string, starting_lng string, starting_lat string")
        rows = [(f"d{i}", "1", "110.2,19.8;110.21,19.8;110.21,19.81;110.2,19.81;110.2,19.8") for i in range(n_districts)]
        got = stations.label_districts(points, stations.district_table(spark, rows))
        per_task = [r["n"] for r in got.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()]
        assert sum(per_task) == (n_points + 1) * n_districts
        assert max(per_task) <= 8 << 10
        assert got.select("order_id", "district_position").distinct().count() == n_points * n_districts
