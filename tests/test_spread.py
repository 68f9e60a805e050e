"""Heavy keys: the spread plans must return what the plain plans return."""

import random

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare.operators import members, stations, tracks
from wayfare.operators.spread import _cut, join_unique, latest_per_key, number_rows


def skewed(spark, rows=3000):
    """A third of the rows belong to one key, another part to a null key, and all share few values."""
    rng = random.Random(3)
    data = []
    for i in range(rows):
        key = "hot" if i % 3 == 0 else None if i % 17 == 0 else f"k{rng.randrange(40)}"
        data.append((key, rng.randrange(5), i))
    return spark.createDataFrame(data, "key string, score int, id int").repartition(4), data


def expected_numbers(data):
    groups = {}
    for key, score, ident in data:
        groups.setdefault(key, []).append((score, -ident, ident))
    return {(key, ident): (n, len(group)) for key, group in groups.items()
            for n, (_, _, ident) in enumerate(sorted(group), 1)}


def test_number_rows_with_and_without_hot_keys(spark):
    df, data = skewed(spark)
    want = expected_numbers(data)
    for limit in (10, 150, 10_000):
        numbered = number_rows(df, ["key"], ["score", "-id"], "n", "total", limit)
        assert {(r["key"], r["id"]): (r["n"], r["total"]) for r in numbered.collect()} == want


def test_most_rows_of_one_key(spark):
    """Nine tenths of the rows have one key: no task of the numbering holds more than a small share of them."""
    df = spark.range(20_000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(F.lit(-1)).alias("key"),
                                    (F.col("id") * 7919 % 20_011).alias("score"), "id")
    pieces = _cut(df, ["key"], ["score", "-id"], 250, "left").groupBy("key", "_piece").count()
    assert pieces.where("key = -1").count() > 40
    assert pieces.agg(F.max("count")).first()[0] < 18_000 / 8
    got = number_rows(df, ["key"], ["score", "-id"], "n", "total", 250).where("key = -1").orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(1, 18_001)) and {r["total"] for r in got} == {18_000}
    assert all((a["score"], -a["id"]) < (b["score"], -b["id"]) for a, b in zip(got, got[1:], strict=False))


def test_no_job_runs_while_a_query_is_built(spark):
    df, _ = skewed(spark)
    right = spark.createDataFrame([("hot", 1)], "key string, v int")
    sc = spark.sparkContext
    sc.setJobGroup("built", "built")
    try:
        number_rows(df, ["key"], ["score", "-id"], "n", "total", 10)
        join_unique(df, right, ["key"], 10)
        members.rank_range(df.withColumnRenamed("id", "member"), -5, -1)
        stations.hot_cell_orders(df.withColumnRenamed("id", "cell"))
        assert list(sc.statusTracker().getJobIdsForGroup("built")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_nulls_in_the_order(spark):
    data = [("k", s, i) for i, s in enumerate([None, 3, None, 1, 2, 3, None, 1])]
    df = spark.createDataFrame(data, "key string, score int, id int")
    for order, turned in ((["score", "id"], [F.asc("score"), F.asc("id")]), (["-score", "id"], [F.desc("score"), F.asc("id")])):
        want = df.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy(*turned)).cast("long"))
        for limit in (1, 2, 3):
            assert sorted(number_rows(df, ["key"], order, "n", rows_per_task=limit).collect(), key=str) == sorted(want.collect(), key=str)


def test_join_unique_with_and_without_hot_keys(spark):
    df, data = skewed(spark)
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), (None, 4)], "key string, v int")
    values = {"hot": 1, "k1": 2, "k2": 3}
    want = sorted((i, values[k]) for k, _, i in data if k in values)
    for limit in (10, 150, 10_000):
        joined = join_unique(df, right, ["key"], limit)
        assert sorted((r["id"], r["v"]) for r in joined.collect()) == want


def test_join_unique_keeps_identical_copies(spark):
    left = spark.range(2000).select(F.lit("hot").alias("key"), F.lit(1).alias("x")).repartition(8)
    right = spark.createDataFrame([("hot", 9)], "key string, v int")
    assert join_unique(left, right, ["key"], 100).count() == 2000


def test_latest_per_key(spark):
    df, data = skewed(spark)
    want = {}
    for key, score, ident in data:
        want[key] = max(want.get(key, (-1, -1)), (ident, score))
    got = {r["key"]: (r["id"], r["score"]) for r in latest_per_key(df, ["key"], ["id"]).collect()}
    assert got == want


def messages(spark, n=900):
    rng = random.Random(5)
    data = []
    for i in range(n):
        order = "hot" if i % 3 == 0 else f"o{rng.randrange(30)}"
        end = i % 50 == 7
        data.append(("xi_an_gps_topic", order,
                     "end" if end else f"d1,{order},{1000 + rng.randrange(60)},104.{i},30.{i}", i))
    df = spark.createDataFrame(data, "topic string, key string, value string, offset long")
    return df.withColumn("ts", F.expr("timestamp_ntz'1970-01-01 00:17:00'")).repartition(4)


def test_track_lists_and_replay_of_a_hot_order(spark):
    tracked = tracks.track_messages(messages(spark))

    def rows(df):
        return sorted(tuple(str(v) for v in r) for r in df.collect())

    plain, spread = tracks.track_list(tracked), tracks.track_list(tracked, rows_per_task=40)
    assert rows(plain) == rows(spread)
    assert rows(tracks.track_replay(tracked)) == rows(tracks.track_replay(tracked, 40))
    for start, stop in ((0, 0), (1, 3), (-2, -1), (2, -3), (0, -1)):
        lists, kept = {}, {}
        for r in plain.collect():
            lists.setdefault(r["order_id"], {})[r["idx"]] = r["item"]
        for r in tracks.list_trim(spread, start, stop).collect():
            kept.setdefault(r["order_id"], {})[r["idx"]] = (r["item"], r["length"])
        for order, items in lists.items():
            array = [items[i] for i in range(len(items))]
            cut = array[start if start >= 0 else max(len(array) + start, 0):
                        (stop + 1 if stop >= 0 else len(array) + stop + 1)]
            assert kept.get(order, {}) == {i: (v, len(cut)) for i, v in enumerate(cut)}


def test_history_of_a_hot_order(spark):
    points = tracks.gps_points(messages(spark))
    spans = tracks.order_spans(points)
    got = sorted(r["offset"] for r in tracks.order_history(points, spans, 40).collect())
    assert got == sorted(r["offset"] for r in tracks.order_history(points, spans).collect())
    bounds = {r["order_id"]: (r["start_epoch"], r["end_epoch"]) for r in spans.collect()}
    assert got == sorted(r["offset"] for r in points.collect()
                         if bounds[r["order_id"]][0] <= r["epoch"] < bounds[r["order_id"]][1])


def test_single_order_range(spark):
    points = tracks.gps_points(messages(spark))
    got = [r["epoch"] for r in tracks.track_range(points, "hot", 1010, 1020).collect()]
    assert got == sorted(got) and set(got) <= set(range(1010, 1020)) and got


def test_rank_ranges_of_a_hot_key(spark):
    data = [("hot" if i % 3 == 0 else f"k{i % 7}", i, i * 37 % 101) for i in range(600)]
    scored = spark.createDataFrame(data, "key string, member int, score int")
    groups = {}
    for key, member, score in data:
        groups.setdefault(key, []).append((score, member))
    for limit in (50, 10_000):
        for start, stop in ((0, 2), (-3, -1), (1, -2)):
            got = {(r["key"], r["member"]) for r in members.rank_range(
                scored, start, stop, rows_per_task=limit).collect()}
            left = {(r["key"], r["member"]) for r in members.remove_rank_range(
                scored, start, stop, limit).collect()}
            want = {(k, m) for k, g in groups.items() for _, m in
                    sorted(g)[start if start >= 0 else len(g) + start:
                              stop + 1 if stop >= 0 else len(g) + stop + 1]}
            assert got == want and left == {(k, m) for k, m, _ in data} - want


def test_crowded_cell_keeps_every_order(spark):
    data = [(str(i), "83", "110.200000" if i % 3 else f"110.{300000 + i * 50}", "19.800000") for i in range(600)]
    orders = spark.createDataFrame(data, "order_id string, city_id string, starting_lng string, starting_lat string")
    gridded = stations.grid_cells(orders)
    plain = stations.hot_cell_orders(gridded)
    assert sorted(map(tuple, plain.collect())) == sorted(
        map(tuple, stations.hot_cell_orders(gridded, rows_per_task=50).collect()))
    assert plain.count() >= 400


def test_merged_cells_outlive_partial_writes(spark):
    from wayfare.operators.spread import merged_per_key
    rows = spark.createDataFrame([("k", "ann", "1", 1), ("k", None, "2", 2), ("j", None, "3", 1)],
                                 "rowkey string, linkman string, state string, offset long")
    assert sorted(tuple(r) for r in merged_per_key(rows, ["rowkey"], ["offset"]).collect()) == [
        ("j", None, "3", 1), ("k", "ann", "2", 2)]
