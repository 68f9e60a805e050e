"""SQL twins of the registered queries, written independently of the operators.

Inputs are derived again in SQL; results come from the tables' own columns rather than through the
JSON and line texts the operators parse.
"""

from __future__ import annotations

from wayfare.constants import (ALLIANCE_FIELDS, DRIVER_FIELDS, GAUGES, HEX_EDGE_M, ORDER_FIELDS,
                               ORDER_LINE_FIELDS, UNSAFE_HTML, USER_FIELDS)
from wayfare.plans.catalog import (BATCH_BOUNDARY, DISTRICTS, QUERY_FROM, QUERY_TO, RETAINED_AS_OF,
                                   SCORE_HIGH, SCORE_LOW, STATION_CITY, STATION_DISTRICT)

ORACLE: dict[str, str] = {}


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def _degrees(micro: str) -> str:
    return (f"concat(cast({micro} // 1000000 as varchar), '.', "
            f"lpad(cast({micro} % 1000000 as varchar), 6, '0'))")


# Inputs.

_RAW = f"""orders_raw AS (
  SELECT o_orderkey AS "offset", cast(o_orderkey AS varchar) AS order_id,
         CASE o_orderkey % 3 WHEN 0 THEN 'hai_kou_order_topic' WHEN 1 THEN 'cheng_du_order_topic'
              ELSE 'xi_an_order_topic' END AS topic,
         CASE o_orderkey % 3 WHEN 0 THEN '83' WHEN 1 THEN '28' ELSE '29' END AS city_id,
         {_degrees('(110200000 + (o_custkey % 10) * 40000 + (o_orderkey % 3) * 4)')} AS starting_lng,
         {_degrees('(19800000 + (o_custkey % 6) * 50000 + (o_orderkey % 2) * 4)')} AS starting_lat,
         cast(o_custkey % 5 AS varchar) AS passenger_count,
         strftime(o_orderdate, '%Y-%m-%d') AS departure_day,
         concat(lpad(cast(o_orderkey % 24 AS varchar), 2, '0'), ':',
                lpad(cast(o_custkey % 60 AS varchar), 2, '0'), ':00') AS departure_time
  FROM orders)"""

_LINES = """order_messages AS (
  SELECT CASE WHEN "offset" % 53 = 0 THEN 'unknown_topic' ELSE topic END AS topic, "offset", order_id,
         CASE WHEN "offset" % 50 = 0 THEN 'order_id product_id city_id'
              WHEN topic <> 'hai_kou_order_topic'
                THEN concat(order_id, ',', starting_lng, ',', starting_lat)
              WHEN "offset" % 33 = 0
                THEN concat(order_id, ' 3 ', departure_day, ' ', departure_time)
              ELSE concat(
                order_id, ' 3 ', city_id, ' 0898 460107 0 0 0 ',
                CASE WHEN "offset" % 41 = 0 THEN 'x' ELSE passenger_count END, ' 3 4361 ',
                departure_day, ' ', departure_time, ' ', departure_day, ' ', departure_time,
                ' 13 11 b', order_id, ' 3 110.3645 20.0353 ', starting_lng, ' ', starting_lat, ' ',
                substr(departure_day, 1, 4), ' ', substr(departure_day, 6, 2), ' ',
                CASE WHEN "offset" % 31 = 0 THEN '' ELSE substr(departure_day, 9, 2) END,
                CASE WHEN "offset" % 29 = 0 THEN ' ' ELSE '' END)
         END AS value
  FROM orders_raw),
checked AS (
  SELECT *, regexp_matches(value, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AS is_data,
         string_split(value, ' ') AS all_parts,
         string_split(regexp_replace(value, ' +$', ''), ' ') AS kept_parts
  FROM order_messages)"""

_PARSED = """parsed AS (
  SELECT "offset", topic,
         CASE WHEN topic = 'hai_kou_order_topic' AND is_data AND len(all_parts) = 26 THEN '460100'
              WHEN topic = 'cheng_du_order_topic' THEN '510100'
              WHEN topic = 'xi_an_order_topic' THEN '610100' END AS city_code,
         all_parts, value
  FROM checked),
by_topic AS (
  SELECT "offset", topic, city_code,
         CASE WHEN city_code = '460100' THEN all_parts[1]
              WHEN city_code IS NOT NULL THEN string_split(value, ',')[1] END AS order_id,
         CASE WHEN city_code = '460100' THEN all_parts[14]
              WHEN city_code IS NOT NULL THEN '' END AS create_day,
         CASE WHEN city_code = '460100' AND try_cast(all_parts[9] AS integer) > 0
                THEN try_cast(all_parts[9] AS integer)
              WHEN city_code IS NOT NULL THEN 1 END AS passengers
  FROM parsed),
totals AS (
  SELECT city_code, create_day, count(*) AS order_count,
         cast(sum(passengers) AS bigint) AS passenger_count
  FROM by_topic WHERE city_code IS NOT NULL GROUP BY ALL)"""

_GPS = """gps AS (
  SELECT event_id AS "offset", user_id, event_type, epoch_us(ts) // 1000000 AS epoch,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS "time",
         CASE WHEN user_id % 2 = 0 THEN '510100' ELSE '610100' END AS city_code,
         concat('d', cast(user_id AS varchar)) AS driver_id,
         concat('o', cast(user_id AS varchar), 'd', strftime(ts, '%d')) AS order_id,
         concat('104.', lpad(cast(50000 + event_id % 40000 AS varchar), 6, '0')) AS lng,
         concat('30.', lpad(cast(600000 + (event_id * 7) % 60000 AS varchar), 6, '0')) AS lat
  FROM events),
points AS (
  SELECT concat(order_id, '_', cast(epoch AS varchar)) AS rowkey, city_code, driver_id, order_id,
         epoch, "time", lng, lat, "offset"
  FROM gps WHERE event_type NOT IN ('error', 'signup')),
tracked AS (
  SELECT city_code, order_id, epoch, "offset", event_type = 'error' AS is_end,
         CASE WHEN event_type = 'error' THEN 'end' ELSE concat(lng, ',', lat) END AS item
  FROM gps WHERE event_type <> 'signup')"""

_LIST = """listed AS (
  SELECT city_code, order_id, item,
         row_number() OVER (PARTITION BY city_code, order_id ORDER BY epoch DESC, "offset" DESC) - 1 AS idx,
         count(*) OVER (PARTITION BY city_code, order_id) AS length
  FROM tracked)"""

_HOURLY = """first_points AS (
  SELECT city_code, order_id, min("time") AS first_time FROM points GROUP BY ALL),
hourly AS (
  SELECT city_code, substr(first_time, 1, 10) AS day, substr(first_time, 12, 2) AS hour,
         count(*) AS order_count
  FROM first_points GROUP BY ALL)"""

# Stations.

_GRID = f"""scaled AS (
  SELECT order_id, city_id, starting_lng, starting_lat,
         (cast(starting_lng AS double) * 111000 * sqrt(3) / 3
          - cast(starting_lat AS double) * 111000 / 3) / {HEX_EDGE_M} AS qf,
         (cast(starting_lat AS double) * 111000 * 2 / 3) / {HEX_EDGE_M} AS rf
  FROM orders_raw),
rounded AS (
  SELECT *, floor(qf + 0.5) AS q0, floor(rf + 0.5) AS r0, floor(-qf - rf + 0.5) AS s0 FROM scaled),
errors AS (
  SELECT *, abs(q0 - qf) AS dq, abs(r0 - rf) AS dr, abs(s0 + qf + rf) AS ds FROM rounded),
gridded AS (
  SELECT order_id, city_id, starting_lng, starting_lat,
         cast(CASE WHEN dq > dr AND dq > ds THEN -r0 - s0 ELSE q0 END AS bigint) * 4294967296
         + cast(CASE WHEN NOT (dq > dr AND dq > ds) AND dr > ds THEN -q0 - s0 ELSE r0 END AS bigint)
           AS cell
  FROM errors),
hot AS (SELECT cell, count(*) AS order_count FROM gridded GROUP BY cell HAVING count(*) >= 10)"""

_CHOSEN = """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY cell ORDER BY starting_lng, starting_lat, order_id) AS rn,
         count(*) OVER (PARTITION BY cell) AS order_count
  FROM gridded),
chosen AS (SELECT * FROM ranked WHERE rn = 1 AND order_count >= 10)"""


def _district_edges() -> str:
    rows = []
    for position, (name, _, polygon) in enumerate(DISTRICTS):
        points = [p.split(",") for p in polygon.split(";") if p]
        for (x1, y1), (x2, y2) in zip(points, points[1:]):
            rows.append(f"({position}, '{name}', {x1}::double, {y1}::double, {x2}::double, {y2}::double)")
    return f"edges(position, name, x1, y1, x2, y2) AS (VALUES {', '.join(rows)})"


_LABELLED = f"""{_district_edges()},
placed AS (
  SELECT *, cast(starting_lng AS double) AS px, cast(starting_lat AS double) AS py FROM chosen),
labelled AS (
  SELECT order_id, city_id, starting_lng, starting_lat, name AS district_name, position
  FROM placed, edges
  GROUP BY ALL
  HAVING sum(CASE WHEN (y1 > py) <> (y2 > py)
                   AND px < (x2 - x1) * (py - y1) / nullif(y2 - y1, 0) + x1 THEN 1 ELSE 0 END) % 2 = 1
     AND sum(CASE WHEN (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1) = 0
                   AND px BETWEEN least(x1, x2) AND greatest(x1, x2)
                   AND py BETWEEN least(y1, y2) AND greatest(y1, y2) THEN 1 ELSE 0 END) = 0),
stations AS (
  SELECT order_id, city_id, starting_lng, starting_lat, district_name
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY position DESC) AS last
        FROM labelled)
  WHERE last = 1)"""

ORACLE["order_scan"] = _with(
    _RAW, select="SELECT order_id, city_id, starting_lng, starting_lat FROM orders_raw")
ORACLE["grid_cells"] = _with(_RAW, _GRID, select="SELECT * FROM gridded")
ORACLE["square_cells"] = _with(_RAW, select="""
SELECT order_id, cast(round_even(cast(starting_lat AS double) * 111 * 1000 / 100, 0) AS integer) AS lat_cell,
       cast(round_even(cast(starting_lng AS double) * 111 * 1000 / 100, 0) AS integer) AS lng_cell
FROM orders_raw""")
ORACLE["hot_cells"] = _with(_RAW, _GRID, select="SELECT * FROM hot")


def _parents(source: str) -> str:
    """CTEs ``up1`` to ``up6``: the nearest parent, by rounding its fractional cube coordinates, six steps up from ``source``."""
    parts = ["""up0 AS (
  SELECT *, (cell - ((cell + 2147483648) % 4294967296 + 4294967296) % 4294967296 + 2147483648) // 4294967296 AS q,
         ((cell + 2147483648) % 4294967296 + 4294967296) % 4294967296 - 2147483648 AS r FROM """ + source + ")"]
    for i in range(6):
        parts.append(f"""up{i + 1} AS (
  SELECT * EXCLUDE (pq, pr), pq AS q, pr AS r, pq * 4294967296 + pr AS cell_{11 - i} FROM (
  SELECT * EXCLUDE (q, r, qf, rf, q0, r0, s0),
         cast(CASE WHEN abs(q0 - qf) > abs(r0 - rf) AND abs(q0 - qf) > abs(s0 + qf + rf) THEN -r0 - s0 ELSE q0 END AS bigint) AS pq,
         cast(CASE WHEN NOT (abs(q0 - qf) > abs(r0 - rf) AND abs(q0 - qf) > abs(s0 + qf + rf)) AND abs(r0 - rf) > abs(s0 + qf + rf)
                   THEN -q0 - s0 ELSE r0 END AS bigint) AS pr
  FROM (SELECT *, floor(qf + 0.5) AS q0, floor(rf + 0.5) AS r0, floor(-qf - rf + 0.5) AS s0
        FROM (SELECT *, (3 * q + r) / 7.0::double AS qf, (2 * r - q) / 7.0::double AS rf FROM up{i}))))""")
    return ",\n".join(parts)


ORACLE["grid_cell_levels"] = _with(_RAW, _GRID, _parents("gridded"), select="SELECT order_id, cell_11, cell_9, cell_6 FROM up6")
ORACLE["hot_cell_parents"] = _with(_RAW, _GRID, _parents("hot"), select=" UNION ALL ".join(f"""
SELECT cell_{r} AS cell, cast(sum(order_count) AS bigint) AS order_count, count(*) AS cells, {r} AS resolution FROM up6 GROUP BY 1"""
                                                                                       for r in (11, 9, 6)))
ORACLE["hot_cell_orders"] = _with(
    _RAW, _GRID, select="SELECT gridded.*, hot.order_count FROM gridded JOIN hot USING (cell)")
ORACLE["cell_representative"] = _with(_RAW, _GRID, _CHOSEN, select="""
SELECT cell, order_count, order_id, city_id, starting_lng, starting_lat FROM ranked WHERE rn = 1""")
ORACLE["station_districts"] = _with(
    _RAW, _GRID, _CHOSEN, _LABELLED,
    select="SELECT order_id, city_id, starting_lng, starting_lat, district_name FROM labelled")
ORACLE["stations"] = _with(_RAW, _GRID, _CHOSEN, _LABELLED, select="SELECT * FROM stations")
ORACLE["station_query"] = _with(_RAW, _GRID, _CHOSEN, _LABELLED, select=f"""
SELECT city_id, district_name, starting_lng, starting_lat FROM stations
WHERE city_id = '{STATION_CITY}' AND district_name = '{STATION_DISTRICT}'""")
ORACLE["station_counts"] = _with(_RAW, _GRID, _CHOSEN, _LABELLED, select=f"""
SELECT district_name, count(*) AS station_count FROM stations
WHERE city_id = '{STATION_CITY}' GROUP BY district_name""")
ORACLE["station_sample"] = _with(
    _RAW, _GRID, _CHOSEN, _LABELLED, select="SELECT * FROM stations ORDER BY order_id LIMIT 100")

_POLYGONS = f"""corners AS (
  SELECT s_suppkey, s_nationkey,
         110000000 + (s_suppkey % 50) * 12000 AS west, 19000000 + (s_suppkey % 30) * 15000 AS south,
         110000000 + (s_suppkey % 50) * 12000 + 10000 + s_suppkey % 7 * 1000 AS east,
         19000000 + (s_suppkey % 30) * 15000 + 9000 + s_suppkey % 5 * 1000 AS north
  FROM supplier),
polygons AS (
  SELECT concat('d', cast(s_suppkey AS varchar)) AS name,
         concat('0', cast(s_nationkey AS varchar)) AS citycode,
         CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE concat(
           {_degrees('west')}, ',', {_degrees('south')}, ';', {_degrees('east')}, ',', {_degrees('south')}, ';',
           {_degrees('east')}, ',', {_degrees('north')}, ';', {_degrees('west')}, ',', {_degrees('north')}, ';',
           {_degrees('west')}, ',', {_degrees('south')}) END AS polygon
  FROM corners)"""

# The districts are rectangles, whose borders do not count as inside.
ORACLE["supplier_districts"] = _with(_POLYGONS, f"""spots AS (
  SELECT cast(c_custkey AS varchar) AS order_id,
         110000000 + (CASE WHEN c_custkey % 10 = 0 THEN 25 ELSE c_custkey END) * 7919 % 600 * 1000 AS px,
         19000000 + (CASE WHEN c_custkey % 10 = 0 THEN 25 ELSE c_custkey END) * 104729 % 460 * 1000 AS py
  FROM customer)""", select=f"""
SELECT order_id, {_degrees('px')} AS starting_lng, {_degrees('py')} AS starting_lat,
       concat('d', cast(s_suppkey AS varchar)) AS district_name, s_suppkey AS district_position
FROM spots, corners WHERE s_suppkey % 7 <> 0 AND px > west AND px < east AND py > south AND py < north""")
ORACLE["polygon_rings"] = _with(_POLYGONS, select="""
SELECT name, concat('POLYGON((', replace(replace(polygon, ',', ' '), ';', ','), '))') AS wkt, cast(i AS integer) AS seq,
       cast(string_split(string_split(polygon, ';')[i + 1], ',')[1] AS double) AS lng,
       cast(string_split(string_split(polygon, ';')[i + 1], ',')[2] AS double) AS lat
FROM polygons, range(5) AS r(i) WHERE polygon <> ''""")
ORACLE["district_rows"] = _with(
    _POLYGONS, select="SELECT citycode, concat(name, '-a') AS name, polygon FROM polygons")
ORACLE["geojson_rings"] = """
SELECT s_name AS name, cast(p AS integer) AS polygon_no, 0 AS ring_no, cast(i AS integer) AS seq,
       cast(s_suppkey % 90 + p AS double) + CASE WHEN i = 1 THEN 0.5 ELSE 0 END AS lng,
       cast(s_suppkey % 45 AS double) + CASE WHEN i = 2 THEN 0.25 ELSE 0 END AS lat
FROM supplier, range(2) AS a(p), range(4) AS b(i)"""

# Order lines.

ORACLE["order_lines_valid"] = _with(_RAW, _LINES, select="""
SELECT "offset", is_data, is_data AND len(all_parts) = 26 AS stream_valid,
       is_data AND len(kept_parts) = 26 AS batch_valid
FROM checked""")
ORACLE["order_lines_parsed"] = _with(
    _RAW, _LINES, select='SELECT topic, "offset", ' + ", ".join(
        f'all_parts[{i + 1}] AS "{n}"' for i, n in enumerate(ORDER_LINE_FIELDS))
    + ', all_parts[14] AS create_day FROM checked WHERE is_data AND len(all_parts) = 26')
ORACLE["order_detail"] = _with(_RAW, _LINES, select="""
SELECT concat(kept_parts[1], '_', replace(kept_parts[14], '-', ''), replace(kept_parts[15], ':', '')) AS rowkey,
       """ + ", ".join(
    f"kept_parts[{i + 1}] AS \"{'type' if n == 'order_time_type' else n}\""
    for i, n in enumerate(ORDER_LINE_FIELDS)
    if n not in ("arrive_day", "arrive_time", "departure_day", "departure_time")) + """,
       concat(kept_parts[12], ' ', kept_parts[13]) AS arrive_time,
       concat(kept_parts[14], ' ', kept_parts[15]) AS departure_time, "offset"
FROM checked WHERE is_data AND len(kept_parts) = 26""")
ORACLE["orders_by_topic"] = _with(_RAW, _LINES, _PARSED, select="SELECT * FROM by_topic")
ORACLE["order_counts"] = _with(_RAW, _LINES, _PARSED, select="""
SELECT concat(city_code, '_', create_day) AS city_day, order_count FROM totals""")
ORACLE["passenger_counts"] = _with(_RAW, _LINES, _PARSED, select="""
SELECT concat(city_code, '_', create_day) AS city_day, passenger_count FROM totals""")
ORACLE["rejected_lines"] = _with(_RAW, _LINES, _PARSED, select="""
SELECT topic, count(*) AS rejected FROM by_topic WHERE city_code IS NULL GROUP BY topic""")
ORACLE["order_overview"] = _with(_RAW, _LINES, _PARSED, _GPS, _HOURLY, """day_hours AS (
  SELECT city_code, day, cast(sum(order_count) AS bigint) AS hour_orders FROM hourly GROUP BY ALL)""",
    select="""
SELECT coalesce(t.city_code, h.city_code) AS city_code, coalesce(t.create_day, h.day) AS day,
       coalesce(h.hour_orders, t.order_count) AS order_count,
       coalesce(t.passenger_count, 0) AS passenger_count
FROM totals t FULL JOIN day_hours h ON t.city_code = h.city_code AND t.create_day = h.day""")

# Change capture.

_CHANGES = """order_changes AS (
  SELECT CASE WHEN o_orderkey % 4 = 0 THEN 'order_info_a' ELSE 'order_info' END AS "table",
         CASE o_orderkey % 5 WHEN 0 THEN 'delete' WHEN 1 THEN 'update' ELSE 'insert' END AS op,
         CASE WHEN o_orderkey % 97 <> 0 THEN cast(o_custkey AS varchar) END AS id,
         CASE WHEN o_custkey % 43 <> 0 THEN concat(
           '2017-05-', lpad(cast(o_custkey % 28 + 1 AS varchar), 2, '0'), ' ',
           lpad(cast(o_custkey % 24 AS varchar), 2, '0'), ':00:00') ELSE '' END AS create_time,
         o_orderstatus AS state, o_orderpriority AS order_type, cast(o_orderkey AS varchar) AS pay_time,
         o_orderkey AS "offset"
  FROM orders),
user_changes AS (
  SELECT 'renter_info' AS "table", CASE WHEN c_custkey % 7 <> 0 THEN 'update' ELSE 'insert' END AS op,
         cast(c_custkey AS varchar) AS id,
         CASE WHEN c_custkey % 3 <> 0 THEN concat(
           '2018-03-', lpad(cast(c_custkey % 28 + 1 AS varchar), 2, '0'), ' 09:15:00') ELSE '' END AS create_time,
         concat('NATION_', cast(c_nationkey AS varchar)) AS last_login_city,
         CASE WHEN c_custkey % 5 <> 0 THEN concat(
           '2018-03-', lpad(cast(c_custkey % 28 + 1 AS varchar), 2, '0'), ' 10:30:00') ELSE '' END AS last_logon_time,
         c_mktsegment AS city_name, c_custkey AS "offset"
  FROM customer),
driver_changes AS (
  SELECT 'driver_info' AS "table", 'insert' AS op, cast(s_suppkey AS varchar) AS id,
         concat('2019-01-', lpad(cast(s_suppkey % 28 + 1 AS varchar), 2, '0'), ' 07:00:00') AS create_time,
         concat('NATION_', cast(s_nationkey AS varchar)) AS register_city, s_name AS driver_name,
         cast(s_suppkey % 4 AS varchar) AS cancel_count, s_suppkey AS "offset"
  FROM supplier),
alliance_changes AS (
  SELECT 'opt_alliance_business' AS "table", 'insert' AS op, cast(n_nationkey AS varchar) AS id,
         n_name AS alliance_name,
         CASE WHEN n_nationkey % 2 = 0 THEN concat('p', cast(n_nationkey AS varchar)) END AS linkman,
         CASE WHEN n_nationkey % 4 <> 0 THEN '2016-02-03 04:05:06' END AS create_time,
         '2016-07-08 09:10:11' AS update_time, '0' AS state, cast(n_nationkey AS bigint) AS "offset"
  FROM nation),
other_changes AS (
  SELECT CASE WHEN p_partkey % 2 = 0 THEN 'unknown_table' ELSE '' END AS "table", 'insert' AS op
  FROM part)"""

_GIVEN = {
    "order": ("create_time", "state", "order_type", "pay_time"),
    "user": USER_FIELDS,
    "driver": ("create_time", "register_city", "driver_name", "cancel_count"),
    "alliance": ("alliance_name", "linkman", "create_time", "update_time", "state"),
}
_FIELDS = {"order": ORDER_FIELDS, "user": USER_FIELDS, "driver": DRIVER_FIELDS,
           "alliance": ALLIANCE_FIELDS}


def _entity_columns(entity: str) -> str:
    missing = "cast(NULL AS varchar)" if entity == "alliance" else "''"
    return ", ".join(f if f in _GIVEN[entity] else f"{missing} AS {f}" for f in _FIELDS[entity])


for _entity, _key in (("order", "cdc_orders"), ("user", "cdc_users"), ("driver", "cdc_drivers"),
                      ("alliance", "cdc_alliances")):
    ORACLE[_key] = _with(_CHANGES, select=f"""
SELECT "table", op, id, {_entity_columns(_entity)}, "offset" FROM {_entity}_changes""")

ORACLE["cdc_routes"] = _with(_CHANGES, select="""
SELECT "table", op, route, count(*) AS messages FROM (
  SELECT "table", op, 'order' AS route FROM order_changes
  UNION ALL SELECT "table", op, 'user' FROM user_changes
  UNION ALL SELECT "table", op, 'driver' FROM driver_changes
  UNION ALL SELECT "table", op, 'alliance' FROM alliance_changes
  UNION ALL SELECT "table", op, '#A' FROM other_changes)
GROUP BY ALL""")


def _salt(pk: str) -> str:
    return (f"list_sum(list_transform(range(1, 16), lambda i: "
            f"(strpos('0123456789abcdef', substr(md5({pk}), i, 1)) - 1) * cast(pow(8, 15 - i) AS bigint))) % 9")


def _rowkey(ident: str, moment: str) -> str:
    pk, short = f"concat({ident}, '_', {moment})", f"concat({ident}, '_', substr({moment}, 3))"
    return (f"concat(lpad(cast(cast({_salt(pk)} AS bigint) AS varchar), 4, '0'), "
            f"substr(md5({short}), 1, 12))")


def _compact(text: str) -> str:
    return f"replace(replace(replace({text}, '-', ''), ':', ''), ' ', '')"


_KEY_TIME = {"order": "create_time", "driver": "create_time",
             "user": "coalesce(nullif(create_time, ''), last_logon_time)",
             "alliance": "coalesce(create_time, update_time)"}


def _writes(entity: str) -> str:
    return f"""timed AS (
  SELECT *, {_compact(_KEY_TIME[entity])} AS moment FROM {entity}_changes
  WHERE op IN ('insert', 'update') AND id IS NOT NULL),
writes AS (
  SELECT *, {_rowkey('id', 'moment')} AS rowkey FROM timed WHERE moment <> ''),
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rowkey ORDER BY "offset" DESC) AS rn FROM writes)
  WHERE rn = 1)"""


ORACLE["cdc_latest"] = _with(_CHANGES, _writes("order"), select="""
SELECT rowkey, "table", op, id, create_time, state, order_type, pay_time, "offset" FROM latest""")
ORACLE["cdc_latest_users"] = _with(_CHANGES, _writes("user"), select="""
SELECT rowkey, id, create_time, last_logon_time, city_name FROM latest""")
ORACLE["cdc_latest_drivers"] = _with(
    _CHANGES, _writes("driver"), select="SELECT rowkey, id, driver_name, cancel_count FROM latest")
ORACLE["cdc_latest_alliances"] = _with(
    _CHANGES, _writes("alliance"), select="SELECT rowkey, id, alliance_name, linkman FROM latest")
ORACLE["cdc_merged_alliances"] = f"""
WITH writes AS (
  SELECT cast(n_nationkey AS varchar) AS id, n_name AS alliance_name,
         CASE WHEN n_nationkey % 2 = 0 THEN concat('p', cast(n_nationkey AS varchar)) END AS linkman,
         NULL AS update_time, '0' AS state, 'insert' AS op, cast(n_nationkey AS bigint) AS "offset" FROM nation
  UNION ALL
  SELECT cast(n_nationkey AS varchar), NULL, CASE WHEN n_nationkey % 3 = 0 THEN concat('q', cast(n_nationkey AS varchar)) END,
         '2016-07-08 09:10:11', NULL, 'update', 1000 + n_nationkey FROM nation
  UNION ALL
  SELECT cast(n_nationkey AS varchar), NULL, NULL, '2016-08-08 09:10:11',
         CASE WHEN n_nationkey % 4 <> 0 THEN '1' END, 'update', 2000 + n_nationkey FROM nation
  UNION ALL
  SELECT cast(n_nationkey AS varchar), CASE WHEN n_nationkey % 5 = 0 THEN concat(n_name, ' 2') END, NULL, NULL, NULL,
         'update', 3000 + n_nationkey FROM nation WHERE n_nationkey % 7 <> 0),
keyed AS (SELECT *, {_rowkey('id', "'20160203040506'")} AS rowkey FROM writes)
SELECT rowkey, id, arg_max(op, "offset") AS op,
       arg_max(alliance_name, "offset") FILTER (alliance_name IS NOT NULL) AS alliance_name,
       arg_max(linkman, "offset") FILTER (linkman IS NOT NULL) AS linkman,
       arg_max(update_time, "offset") FILTER (update_time IS NOT NULL) AS update_time,
       arg_max(state, "offset") FILTER (state IS NOT NULL) AS state, max("offset") AS "offset"
FROM keyed GROUP BY rowkey, id"""
ORACLE["bucket_histogram"] = _with(_CHANGES, _writes("order"), select="""
SELECT cast(substr(rowkey, 1, 4) AS integer) AS bucket, count(*) AS row_count,
       concat(substr(rowkey, 1, 4), '|') AS boundary
FROM writes GROUP BY ALL""")
ORACLE["salted_keys"] = _with(_RAW, f"""timed AS (
  SELECT order_id, {_compact("concat(departure_day, ' ', departure_time)")} AS moment FROM orders_raw)""",
    select=f"""
SELECT order_id, moment, cast({_salt("concat(order_id, '_', moment)")} AS bigint) AS salt,
       {_rowkey('order_id', 'moment')} AS rowkey
FROM timed""")


def _entity_text(entity: str) -> str:
    id_name = "id_" if entity == "alliance" else "id"
    pairs = [("table", '"table"'), ("operatorType", "op"), (id_name, "id")]
    missing = "NULL" if entity == "alliance" else "''"
    pairs += [(f, f if f in _GIVEN[entity] else missing) for f in _FIELDS[entity]]
    items = ", ".join(f"'{name}=' || {value}" for name, value in pairs)
    return (f"SELECT '{entity}' AS kind, \"offset\", array_to_string(list_sort(list_filter([{items}], "
            f"lambda p: p IS NOT NULL)), '|') AS entity FROM {entity}_changes")


ORACLE["entity_map"] = _with(
    _CHANGES, select=" UNION ALL ".join(_entity_text(e) for e in ("order", "user", "driver", "alliance")))

# Tracks.

ORACLE["gps_points"] = _with(_GPS, select="SELECT * FROM points")
ORACLE["track_table"] = _with(_GPS, select="""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY rowkey ORDER BY "offset" DESC) AS rn FROM points)
WHERE rn = 1""")
ORACLE["live_orders"] = _with(_GPS, select="""
SELECT DISTINCT concat(city_code, '_', order_id) AS live_key, city_code, order_id
FROM points WHERE city_code = '510100'""")
ORACLE["new_orders"] = _with(_GPS, select=f"""
SELECT city_code, order_id FROM points GROUP BY ALL HAVING min("time") >= '{BATCH_BOUNDARY}'""")
ORACLE["order_span"] = _with(_GPS, select="""
SELECT order_id, min(epoch) AS start_epoch, max(epoch) AS end_epoch FROM points GROUP BY order_id""")
ORACLE["order_lifecycle"] = _with(_GPS, select="""
SELECT city_code, order_id, min(epoch) FILTER (NOT is_end) AS start_epoch,
       max(epoch) FILTER (NOT is_end) AS end_epoch, count(*) FILTER (NOT is_end) AS points,
       bool_or(is_end) AS closed
FROM tracked GROUP BY ALL HAVING count(*) FILTER (NOT is_end) > 0""")
ORACLE["track_list"] = _with(
    _GPS, _LIST, select="SELECT city_code, order_id, idx, length, item FROM listed")
ORACLE["track_slice"] = _with(_GPS, _LIST, select="""
SELECT city_code, order_id, idx, length, item FROM listed WHERE idx >= 1 AND idx <= length - 2""")
ORACLE["track_index"] = _with(_GPS, _LIST, select="""
SELECT city_code, order_id, idx, length, item FROM listed WHERE idx = length - 1""")
ORACLE["track_trim"] = _with(_GPS, _LIST, select="""
SELECT city_code, order_id, idx - greatest(length - 3, 0) AS idx, least(length, 3) AS length, item
FROM listed WHERE idx >= length - 3""")
ORACLE["track_replay"] = _with(_GPS, select="""
SELECT city_code, order_id,
       row_number() OVER (PARTITION BY city_code, order_id ORDER BY epoch, "offset") AS seq, item
FROM tracked""")
ORACLE["track_range"] = _with(_GPS, """spans AS (
  SELECT order_id, min(epoch) AS a, max(epoch) AS b FROM points GROUP BY order_id)""", select="""
SELECT rowkey, order_id, epoch, lng, lat, "offset" FROM points JOIN spans USING (order_id)
WHERE epoch >= a AND epoch < (a + b) // 2""")
ORACLE["order_history"] = _with(_GPS, """spans AS (
  SELECT order_id, min(epoch) AS a, max(epoch) AS b FROM points GROUP BY order_id)""", select="""
SELECT rowkey, order_id, driver_id, epoch, lng, lat, "offset" FROM points JOIN spans USING (order_id)
WHERE epoch >= a AND epoch < b""")
ORACLE["track_query"] = _with(_GPS, select=f"""
SELECT rowkey, driver_id, order_id, epoch, "time", lng, lat FROM points
WHERE "time" >= '{QUERY_FROM}' AND "time" <= '{QUERY_TO}' AND city_code = '610100'""")
ORACLE["track_query_points"] = _with(
    _GPS, select=f"""SELECT "time", lng, lat FROM points WHERE "time" >= '{QUERY_FROM}'""")
ORACLE["typed_track"] = _with(_GPS, select="""
SELECT driver_id AS "driverId", order_id AS "orderId", epoch AS "timestamp",
       cast(lng AS double) AS lng, cast(lat AS double) AS lat
FROM points""")
ORACLE["hourly_orders"] = _with(_GPS, _HOURLY, select="SELECT * FROM hourly")
ORACLE["hourly_series"] = _with(_GPS, _HOURLY, """days AS (SELECT DISTINCT city_code, day FROM hourly),
slots AS (
  SELECT city_code, day, lpad(cast(h AS varchar), 2, '0') AS hour FROM days, range(24) AS r(h))""", select="""
SELECT city_code, day, hour, coalesce(order_count, 0) AS order_count
FROM slots LEFT JOIN hourly USING (city_code, day, hour)""")
ORACLE["hour_count_map"] = _with(_GPS, _HOURLY, select="""
SELECT city_code, day,
       string_agg(concat(city_code, '_', day, '_', hour), ',' ORDER BY hour) AS fields,
       cast(sum(order_count) AS bigint) AS total, bool_or(hour = '08') AS has_08,
       cast(sum(order_count) FILTER (hour = '08') AS bigint) AS at_08
FROM hourly GROUP BY city_code, day""")

# Metrics.

ORACLE["gauge_extract"] = "SELECT event_id AS snapshot, " + ", ".join(
    f"CASE WHEN event_id % 10 <> 0 THEN event_id + {i} END AS {n}" if n == "remaining_mem_mb"
    else f"event_id + {i} AS {n}" for i, n in enumerate(GAUGES)) + \
    ", cast(-1 AS bigint) AS processing_time FROM events"

_TASKS = """tasks AS (
  SELECT *, l_orderkey * 8 + l_linenumber AS task_id, cast(l_quantity AS bigint) AS size
  FROM lineitem WHERE l_linenumber <> 7)"""
ORACLE["task_metrics"] = _with(_TASKS, select="SELECT task_id, " + ", ".join(
    f"size + {i} AS {n}" for i, n in enumerate((
        "deserialize_time", "deserialize_cpu_time", "run_time", "cpu_time", "result_size", "gc_time",
        "result_serialization_time", "memory_spilled", "disk_spilled", "peak_memory"))) + " FROM tasks")
ORACLE["shuffle_metrics"] = _with(_TASKS, select="""
SELECT task_id, size * 2 AS remote_blocks, size * 3 AS local_blocks, size * 4 AS remote_bytes,
       size * 5 AS local_bytes, size * 6 AS fetch_wait, size * 7 AS records_read,
       size * 11 AS bytes_written, size * 12 AS records_written, size * 13 AS write_time
FROM tasks""")
ORACLE["io_metrics"] = _with(_TASKS, select="""
SELECT task_id, l_partkey AS bytes_read, size AS records_read, l_partkey * 2 AS bytes_written,
       size * 2 AS records_written
FROM tasks""")
ORACLE["task_info"] = _with(_TASKS, select="""
SELECT task_id, concat('h', cast(l_suppkey AS varchar)) AS host, l_linenumber = 2 AS speculative,
       l_linenumber = 3 AS failed, l_linenumber = 5 AS killed, false AS running
FROM tasks""")
ORACLE["block_statuses"] = _with(_TASKS, select="""
SELECT task_id, concat('rdd_', cast(l_orderkey % 100 AS varchar), '_', cast(i AS varchar)) AS block_id, i = 0 AS in_memory, i = 1 AS on_disk,
       CASE i WHEN 0 THEN cast(l_quantity AS bigint) * 10 ELSE 0 END AS memory_size,
       CASE i WHEN 1 THEN cast(l_quantity AS bigint) * 20 ELSE 0 END AS disk_size
FROM tasks, range(2) t(i) WHERE i < l_linenumber % 3""")
ORACLE["failed_tasks"] = _with(_TASKS, select="""
SELECT task_id, CASE l_linenumber WHEN 3 THEN 'ExceptionFailure' ELSE 'TaskKilled' END AS reason,
       CASE l_linenumber WHEN 3 THEN concat('java.io.IOException: disk ', cast(l_orderkey AS varchar))
            ELSE 'another attempt succeeded' END AS message
FROM tasks WHERE l_linenumber IN (3, 5)""")
ORACLE["record_total"] = "SELECT count(*) AS records FROM orders"
ORACLE["batch_throughput"] = """
WITH b AS (
  SELECT epoch_us(ts) // 3600000000 AS batch_id, count(*) AS records,
         (max(epoch_us(ts) // 1000000) - min(epoch_us(ts) // 1000000)) * 1000 AS cost_ms
  FROM events GROUP BY ALL)
SELECT batch_id, records, cost_ms, records / nullif(cost_ms, 0) AS per_ms FROM b"""
ORACLE["slow_batches"] = """
SELECT event_id AS batch_id, event_id % 20 * 1000 AS total_delay_ms FROM events WHERE event_id % 20 > 6"""
ORACLE["metrics_retained"] = f"""
SELECT event_id FROM events
WHERE ts > timestamp '{RETAINED_AS_OF}' - INTERVAL 86400 SECOND AND ts <= timestamp '{RETAINED_AS_OF}'"""

ORACLE["listener_retained"] = f"""
SELECT event_id FROM events
WHERE ts > timestamp '{RETAINED_AS_OF}' - INTERVAL 3600 SECOND AND ts <= timestamp '{RETAINED_AS_OF}'"""

# Keyed members.

_SCORES = """scores AS (
  SELECT event_type AS key, user_id AS member, cast(sum(cast(round(value * 100) AS bigint)) AS bigint) AS score
  FROM events GROUP BY ALL),
ranks AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY score, member) - 1 AS up,
         row_number() OVER (PARTITION BY key ORDER BY score DESC, member DESC) - 1 AS down,
         count(*) OVER (PARTITION BY key) AS members
  FROM scores)"""
ORACLE["counter_increments"] = _with(
    _SCORES, select="SELECT key, member AS field, score AS value FROM scores")
ORACLE["set_cardinality"] = """
SELECT concat(event_type, '_', strftime(ts, '%Y-%m-%d')) AS key, count(DISTINCT user_id) AS members
FROM events GROUP BY ALL"""
ORACLE["member_rank"] = _with(
    _SCORES, select="SELECT key, member, score, up AS rank, members FROM ranks")
ORACLE["member_rank_desc"] = _with(
    _SCORES, select="SELECT key, member, score, down AS rank, members FROM ranks")
ORACLE["top_members"] = _with(
    _SCORES, select="SELECT key, member, score, down AS rank FROM ranks WHERE down <= 9")
ORACLE["bottom_members"] = _with(
    _SCORES, select="SELECT key, member, score, down AS rank FROM ranks WHERE down >= members - 5")
ORACLE["score_range"] = _with(
    _SCORES, select=f"SELECT * FROM scores WHERE score >= {SCORE_LOW} AND score <= {SCORE_HIGH}")
ORACLE["score_count"] = _with(_SCORES, select=f"""
SELECT key, count(*) AS members FROM scores
WHERE score >= {SCORE_LOW} AND score <= {SCORE_HIGH} GROUP BY key""")
ORACLE["rank_removed"] = _with(
    _SCORES, select="SELECT key, member, score FROM ranks WHERE up < 2 OR up > members - 3")
ORACLE["score_removed"] = _with(
    _SCORES, select=f"SELECT * FROM scores WHERE score < {SCORE_LOW} OR score > {SCORE_HIGH}")
_SETS = """sets AS (
  SELECT event_type AS key, concat(cast(user_id AS varchar), '_', strftime(ts, '%Y-%m-%d')) AS member
  FROM events)"""
ORACLE["set_union"] = _with(_SETS, select="""
SELECT member FROM sets WHERE key = 'click' UNION SELECT member FROM sets WHERE key = 'purchase'""")
ORACLE["set_intersect"] = _with(_SETS, select="""
SELECT member FROM sets WHERE key = 'click' INTERSECT SELECT member FROM sets WHERE key = 'purchase'
INTERSECT SELECT member FROM sets WHERE key = 'view'""")
ORACLE["set_except"] = _with(_SETS, select="""
SELECT member FROM sets WHERE key = 'click' EXCEPT SELECT member FROM sets WHERE key IN ('purchase', 'view')""")

# Scalars and text.

ORACLE["time_formats"] = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS full_text,
       CASE WHEN event_id % 7 <> 0 THEN strftime(ts, '%Y%m%d%H%M%S') END AS compact,
       CASE WHEN event_id % 7 <> 0 THEN strftime(ts, '%Y%m%d %H:%M:%S')
            ELSE strftime(ts, '%Y%m%d') END AS no_dashes,
       strftime(ts - INTERVAL 15 DAY, '%Y%m%d%H%M') AS half_month_back,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS from_millis,
       strftime(ts, '%Y%m') AS month, strftime(ts, '%H') AS hour
FROM events"""


ORACLE["order_json"] = _with(_RAW, select="""
SELECT order_id, cast(json_object('order_id', order_id, 'city_id', city_id, 'starting_lng', starting_lng,
                                  'starting_lat', starting_lat) AS varchar) AS object
FROM orders_raw""")


def _html() -> str:
    text = "html"
    for pattern in UNSAFE_HTML:
        text = f"regexp_replace({text}, '{pattern}', '', 'gi')"
    return text


ORACLE["html_filter"] = f"SELECT page_id, {_html()} AS html FROM pages"
ORACLE["word_count"] = r"""
WITH lines AS (
  SELECT unnest(regexp_split_to_array(regexp_replace(text, '(\r\n|\n|\r)$', ''), '\r\n|\n|\r')) AS line
  FROM documents),
words AS (
  SELECT unnest(CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN []
                     ELSE string_split(rtrim(line, ' '), ' ') END) AS word
  FROM lines)
SELECT word, count(*) AS occurrences FROM words GROUP BY word"""
