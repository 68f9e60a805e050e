"""Column functions against known values."""

import random

import pytest
from pyspark.sql import functions as F

from wayfare.constants import HEX_EDGE_M
from wayfare.functions import geo, keys, text, times
from wayfare.operators import orders, tracks

LINE = ("17592719043682 3 83 0898 460107 0 0 0 4 3 4361 2017-05-19 01:09:12 2017-05-19 01:05:19 13 11 "
        "10466d3f609cb938dd153738103b0303 3 110.3645 20.0353 110.3665 20.0059 2017 05 19")


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("entity,time,expected", [
    ("1001", "20190817120000", "0008d2fe1997d524"),
    ("17592719043682", "20170519010519", "00029601580e4f25")])
def test_salted_key(spark, entity, time, expected):
    assert value(spark, keys.salted_key(F.lit(entity), F.lit(time))) == expected


def test_salted_key_without_time_is_null(spark):
    assert value(spark, keys.salted_key(F.lit("1"), F.lit(None).cast("string"))) is None


def test_salts_stay_in_range_and_land_in_their_range(spark):
    salts = spark.range(5000).select(keys.salt(F.col("id").cast("string")).alias("s"))
    low, high, distinct = salts.agg(F.min("s"), F.max("s"), F.countDistinct("s")).first()
    assert (low, high, distinct) == (0, 8, 9)
    boundaries = keys.split_keys(9)
    assert boundaries[:2] == ["0000|", "0001|"] and len(boundaries) == 9
    key = "0003d2fe1997d524"
    assert boundaries[2] < key < boundaries[3]
    assert value(spark, keys.key_range(F.lit(key))) == 3


@pytest.mark.parametrize("given,expected", [
    ("2017-05-19 01:05:19", "20170519010519"), ("2017-05-19", None), ("", None), ("   ", None),
    ("2017-05-19 ", None), (None, None)])
def test_compact_time(spark, given, expected):
    assert value(spark, times.compact_time(F.lit(given).cast("string"))) == expected


@pytest.mark.parametrize("given,expected", [("2017-05-19", "20170519"), (" ", None)])
def test_compact_day(spark, given, expected):
    assert value(spark, times.compact_day(F.lit(given))) == expected


@pytest.mark.parametrize("given,expected", [
    ("201903101230", "201902231230"), ("202003100000", "202002240000"), ("x", None)])
def test_half_month_back(spark, given, expected):
    assert value(spark, times.minus_days(F.lit(given))) == expected


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai", "America/New_York"])
def test_epochs_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert value(spark, times.epoch_millis_to_text(F.lit(1568025609176))) == "2019-09-09 10:40:09"
        # A local time skipped in New York.
        assert value(spark, times.epoch_to_text(F.lit(1552185000))) == "2019-03-10 02:30:00"
        assert value(spark, times.to_epoch(F.expr("timestamp_ntz'2019-03-10 02:30:00.9'"))) == 1552185000
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_month_suffix(spark):
    assert value(spark, times.month_suffix(F.expr("date'2019-10-05'"))) == "201910"
    assert value(spark, times.month_suffix(F.expr("date'2019-11-05'"))) == "201911"
    assert len(value(spark, times.now_as("yyyyMMdd"))) == 8


def test_square_cell(spark):
    assert value(spark, geo.square_cell(F.lit(20.0059))) == 22207
    assert value(spark, geo.square_cell(F.lit(110.3665))) == 122507


def nearest_hexagon(lat, lng, edge):
    """Round cube coordinates and repair the component with the largest error."""
    x, y = lng * 111000.0, lat * 111000.0
    q = (x * 3 ** 0.5 / 3 - y / 3) / edge
    r = (y * 2 / 3) / edge
    s = -q - r
    whole = [int((v + 0.5) // 1) for v in (q, r, s)]
    errors = [abs(w - v) for w, v in zip(whole, (q, r, s))]
    worst = errors.index(max(errors))
    whole[worst] = -sum(w for i, w in enumerate(whole) if i != worst)
    return whole[0], whole[1]


def test_hexagons_match_cube_rounding(spark):
    rng = random.Random(7)
    points = [(i, repr(rng.uniform(-80, 80)), repr(rng.uniform(-179, 179))) for i in range(3000)]
    df = spark.createDataFrame(points, "i int, lat string, lng string")
    q, r = geo.hex_axial(F.col("lat"), F.col("lng"))
    found = {row["i"]: (row["q"], row["r"]) for row in df.select("i", q.alias("q"), r.alias("r")).collect()}
    assert found == {i: nearest_hexagon(float(a), float(b), HEX_EDGE_M) for i, a, b in points}


def test_unreadable_coordinates_have_no_cell(spark):
    assert value(spark, geo.hex_cell(F.lit("x"), F.lit("110.3"))) is None


def test_order_line_of_26_fields(spark):
    messages = spark.createDataFrame([(LINE, 1), ("order_id city_id", 2), ("1 2017-05-19", 3)],
                                     "value string, offset long")
    row, = orders.parse_lines(messages).collect()
    assert (row["departure_day"], row["passenger_count"], row["create_day"]) == ("2017-05-19", "4", "2017-05-19")
    detail, = orders.order_detail(messages).collect()
    assert detail["rowkey"] == "17592719043682_20170519010519"
    assert detail["arrive_time"] == "2017-05-19 01:09:12"
    assert len(detail) == 26  # row key, 24 columns, offset


def test_trailing_blank_counts_for_one_reader_only(spark):
    messages = spark.createDataFrame([(LINE + " ", 1), (LINE[:-2], 2)], "value string, offset long")
    checks = {r["offset"]: (r["stream_valid"], r["batch_valid"])
              for r in orders.line_checks(messages).collect()}
    assert checks == {1: (False, True), 2: (True, False)}


def test_topics(spark):
    city = orders.city_of_topic(F.lit("XI_AN_gps_topic"), {"xi_an_gps_topic": "610100"}, strict=True)
    assert value(spark, city) == "610100"
    unknown = orders.city_of_topic(F.lit("nope"), {"xi_an_gps_topic": "610100"})
    assert value(spark, unknown) is None
    with pytest.raises(Exception, match="not a known topic"):
        value(spark, orders.city_of_topic(F.lit("nope"), {"xi_an_gps_topic": "610100"}, strict=True))


def test_passengers_fall_back_to_one(spark):
    lines = [LINE.replace(" 4 3 4361", f" {p} 3 4361") for p in ("4", "0", "x", "-2")]
    messages = spark.createDataFrame(
        [("hai_kou_order_topic", line, i) for i, line in enumerate(lines)]
        + [("xi_an_order_topic", "o1,x", 9), ("other", "o2,x", 10), ("hai_kou_order_topic", "head", 11)],
        "topic string, value string, offset long")
    totals = {(r["city_code"], r["create_day"]): (r["order_count"], r["passenger_count"])
              for r in orders.order_totals(messages).collect()}
    assert totals == {("460100", "2017-05-19"): (4, 7), ("610100", ""): (1, 1)}
    assert orders.reject_count(messages).agg(F.sum("rejected")).first()[0] == 2


def test_safe_html(spark):
    html = '<SCRIPT>x()</script >a<a onclick="go()" href=javascript:go()>b</a><iframe src=x></iframe><link rel=x/>'
    assert value(spark, text.safe_html(F.lit(html))) == 'a<a "go()" go()>b</a>'


def test_live_keys(spark):
    key = keys.live_key(F.lit("510100"), F.lit("o_1"))
    assert value(spark, key) == "510100_o_1"
    assert value(spark, keys.live_key_order(key)) == "o_1"


def test_point_and_polygon_text(spark):
    assert value(spark, geo.point_wkt(F.lit("1.5"), F.lit("2"))) == "POINT(1.5 2)"
    assert value(spark, geo.polygon_wkt(F.lit("1,2;3,4;1,2"))) == "POLYGON((1 2,3 4,1 2))"


def test_typed_rows(spark):
    stored = spark.createDataFrame([("7", "104.5", "1568025609", "x")],
                                   "NUM string, Lng string, WHEN_ string, BAD string")
    row = tracks.typed_rows(stored, [("num", "int"), ("lng", "double"), ("when_", "date"), ("bad", "bigint"),
                                     ("absent", "int")]).first()
    assert tuple(row) == (7, 104.5, "2019-09-09", None, None)


def test_cells_have_seven_children_and_one_parent(spark):
    """Parents by the nearest middle, over a patch of cells around the origin and far from it."""
    import itertools
    from fractions import Fraction

    def nearest(q, r):
        x, y = Fraction(3 * q + r, 7), Fraction(2 * r - q, 7)
        a, b, c = round(x), round(y), round(-x - y)
        if abs(a - x) > max(abs(b - y), abs(c + x + y)):
            a = -b - c
        elif abs(b - y) > abs(c + x + y):
            b = -a - c
        return a, b

    axial = [(q + far, r - 3 * far) for q, r in itertools.product(range(-12, 13), repeat=2) for far in (0, 1_000_003)]
    frame = spark.createDataFrame(axial, "q long, r long").select("q", "r", geo.packed(F.col("q"), F.col("r")).alias("cell"))
    rows = frame.select("*", *[c.alias(n) for c, n in zip(geo.unpacked(F.col("cell")), ("q2", "r2"), strict=True)],
                        *[c.alias(n) for c, n in zip(geo.unpacked(geo.cell_parent(F.col("cell"))), ("pq", "pr"), strict=True)],
                        geo.cell_children(geo.cell_parent(F.col("cell"))).alias("siblings"),
                        (geo.cell_parent(F.col("cell"), 3) == geo.cell_parent(geo.cell_parent(F.col("cell"), 2))).alias("steps")).collect()
    for row in rows:
        assert (row["q2"], row["r2"]) == (row["q"], row["r"])
        assert (row["pq"], row["pr"]) == nearest(row["q"], row["r"])
        assert row["cell"] in row["siblings"] and len(set(row["siblings"])) == 7 and row["steps"]
    with pytest.raises(ValueError, match="resolution 12"):
        geo.hex_cell(F.lit("1"), F.lit("2"), resolution=13)
    assert abs(geo.hex_edge(10) / geo.hex_edge(12) - 7) < 1e-9
