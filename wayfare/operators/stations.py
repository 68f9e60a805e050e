"""Virtual stations: hexagonal grid, hot cells, representatives, districts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.constants import HEX_EDGE_M, HEX_RESOLUTION, MIN_CELL_ORDERS
from wayfare.functions import geo
from wayfare.operators.spread import ROWS_PER_TASK, join_unique

# Powers of two in degrees that tiles come in; the last holds any coordinates on Earth.
LEVELS = tuple(range(-12, 10))
# Pairs of a point and a district that a task should compare, and points and districts of a square piece of a tile.
PAIRS_PER_TASK, SIDE = 1 << 22, 1 << 10
MAX_TASKS = 100_000


def grid_cells(orders: DataFrame, edge_m: float = HEX_EDGE_M, resolution: int = HEX_RESOLUTION) -> DataFrame:
    """Orders with the hexagon they start in; unreadable coordinates give no cell."""
    return orders.withColumn(
        "cell", geo.hex_cell(F.col("starting_lat"), F.col("starting_lng"), edge_m, resolution))


def cell_rollup(counts: DataFrame, resolution: int) -> DataFrame:
    """Orders per cell of a coarser resolution from those per cell; only counts are grouped, no orders.

    ``counts`` has ``cell`` and ``order_count``; ``cells`` tells how many of them a coarser cell holds.
    """
    return (counts.groupBy(geo.cell_parent(F.col("cell"), HEX_RESOLUTION - resolution).alias("cell"))
            .agg(F.sum("order_count").alias("order_count"), F.count("*").alias("cells")))


def square_cells(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id",
        geo.square_cell(F.col("starting_lat").try_cast("double")).alias("lat_cell"),
        geo.square_cell(F.col("starting_lng").try_cast("double")).alias("lng_cell"))


def hot_cells(gridded: DataFrame, min_orders: int = MIN_CELL_ORDERS) -> DataFrame:
    """Orders per cell, cells with enough of them only."""
    return (gridded.where(F.col("cell").isNotNull())
            .groupBy("cell").agg(F.count("*").alias("order_count"))
            .where(F.col("order_count") >= min_orders))


def hot_cell_orders(gridded: DataFrame, min_orders: int = MIN_CELL_ORDERS,
                    rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Every order of a hot cell with the cell's count; a crowded cell is cut into pieces."""
    return join_unique(gridded, hot_cells(gridded, min_orders), ["cell"], rows_per_task)


def cell_representatives(gridded: DataFrame, min_orders: int = 1) -> DataFrame:
    """Per cell the first order by longitude, latitude (as text) and order id, and the cell's count.

    This is ``row_number() = 1`` over the cell, written as an aggregate so that a crowded cell is
    reduced before the shuffle, and counted in the same pass.
    """
    first = F.min(F.struct("starting_lng", "starting_lat", "order_id", "city_id")).alias("first")
    return (gridded.where(F.col("cell").isNotNull()).groupBy("cell")
            .agg(F.count("*").alias("order_count"), first)
            .where(F.col("order_count") >= min_orders)
            .select("cell", "order_count", "first.order_id", "first.city_id",
                    "first.starting_lng", "first.starting_lat"))


def district_table(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    """Districts given as (name, citycode, polygon) in their listing order."""
    return spark.createDataFrame(
        [(i, *row) for i, row in enumerate(rows)],
        "position bigint, name string, citycode string, polygon string")


def district_edges(districts: DataFrame) -> DataFrame:
    """Districts with a polygon, as ring edges and bounding box."""
    points = districts.where(F.coalesce(F.col("polygon"), F.lit("")) != "").withColumn(
        "ring", geo.ring_points(F.col("polygon")))
    return points.select(
        "position", "name", geo.ring_edges(F.col("ring")).alias("edges"),
        F.array_min("ring.lng").alias("west"), F.array_max("ring.lng").alias("east"),
        F.array_min("ring.lat").alias("south"), F.array_max("ring.lat").alias("north"))


def _inside() -> Column:
    lng, lat = F.col("_lng"), F.col("_lat")
    return (lng.between(F.col("west"), F.col("east")) & lat.between(F.col("south"), F.col("north"))
            & geo.inside_ring(lng, lat, F.col("edges")))


def label_districts(points: DataFrame, districts: DataFrame, rows_per_task: int | None = ROWS_PER_TASK) -> DataFrame:
    """One row per point and district strictly containing it; points outside all are dropped.

    Points and districts meet by tile, in a quadtree of tiles. A district takes the least tile size of ``LEVELS`` that
    its extent fits in, so it covers at most four tiles, and a point is looked up once for each size that occurs: one tile
    for districts of like extent. The work of a tile is its points times its districts: tiles of much work are cut on both sides, and
    there are as many tasks as the pairs to compare ask for, which one count of both sides by tile tells beforehand.
    Spark picks the join by the measured size of the district tiles. Without ``rows_per_task`` no tile is cut and nothing counted: for
    points that are few in any tile by their nature, such as one for each cell.
    """
    located = (points.withColumn("_lng", F.col("starting_lng").try_cast("double"))
               .withColumn("_lat", F.col("starting_lat").try_cast("double")))
    tiles, looked_up = district_tiles(located, district_edges(districts))
    joined = looked_up.join(tiles, list(TILE)) if rows_per_task is None else join_by_work(looked_up, tiles, rows_per_task)
    matched = joined.where(_inside())
    return matched.select(*points.columns, F.col("name").alias("district_name"), F.col("position").alias("district_position"))


TILE = ("_x", "_y", "_level")


def district_tiles(located: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Districts by the tiles they cover, and points by the tile they lie in at each size in use."""
    extent = F.greatest(F.col("east") - F.col("west"), F.col("north") - F.col("south"))
    fits = F.array(*[F.when(extent <= 2.0 ** level, F.lit(level)) for level in LEVELS])
    levelled = edges.withColumn("_level", F.coalesce(F.array_min(fits), F.lit(LEVELS[-1])))

    def tile(degrees: Column) -> Column:
        return F.floor(degrees / F.pow(F.lit(2.0), F.col("_level"))).cast("long")

    tiles = (levelled.withColumn("_x", F.explode(F.sequence(tile(F.col("west")), tile(F.col("east")))))
             .withColumn("_y", F.explode(F.sequence(tile(F.col("south")), tile(F.col("north"))))))
    # At most as many as there are LEVELS.
    in_use = levelled.agg(F.array_sort(F.collect_set("_level")).alias("levels")).scalar()
    looked_up = (located.withColumn("_levels", in_use).withColumn("_level", F.explode("_levels")).drop("_levels")
                 .withColumn("_x", tile(F.col("_lng"))).withColumn("_y", tile(F.col("_lat"))))
    return tiles, looked_up


def _work(looked_up: DataFrame, tiles: DataFrame) -> DataFrame:
    """``_points`` and ``_districts`` of every tile with points; a tile without districts counts as one with one."""
    theirs = tiles.groupBy(*TILE).agg(F.count("*").alias("_districts"))
    return (looked_up.groupBy(*TILE).agg(F.count("*").alias("_points")).join(theirs, list(TILE), "left")
            .fillna(1, ["_districts"]))


def _crowded(work: DataFrame, rows_per_task: int) -> DataFrame:
    """How often the points (``_cuts``) and the districts (``_parts``) of a tile are cut, where one is; one row in ``SIDE`` squared pairs.

    Pieces are squares, or of all rows of a side that has fewer, so that few rows are copied to the pieces of the other side.
    """
    def pieces(rows: str, others: str) -> Column:
        most = F.greatest(F.lit(SIDE), F.lit(SIDE * SIDE) / F.col(others))
        return F.ceil(F.col(rows) / (F.least(F.lit(rows_per_task), most) if rows == "_points" else most)).cast("int")

    cut = work.select(*TILE, pieces("_points", "_districts").alias("_cuts"), pieces("_districts", "_points").alias("_parts"))
    return F.broadcast(cut.where(F.col("_cuts") + F.col("_parts") > 2))


def join_by_work(looked_up: DataFrame, tiles: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Points joined to the districts of their tile; no task compares many more than ``PAIRS_PER_TASK`` pairs."""
    points = looked_up.where(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    work = _work(points, tiles)
    pairs, rows = work.agg(F.sum(F.col("_points").cast("double") * F.col("_districts")), F.sum("_points")).first()
    tasks = min(MAX_TASKS, max(1, -int(-(pairs or 0) // PAIRS_PER_TASK), -(-(rows or 0) // rows_per_task)))
    crowded = _crowded(work, rows_per_task)

    def dealt(side: DataFrame, own: str, own_pieces: str, other: str, other_pieces: str) -> DataFrame:
        """A row goes to one piece of its own side, and with it to every piece of the other side."""
        any_piece = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in side.columns])
        return (side.withColumn("_hash", any_piece).join(crowded, list(TILE), "left")
                .withColumn(own, F.pmod("_hash", F.coalesce(own_pieces, F.lit(1))).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(other_pieces, F.lit(1)) - 1)))
                .drop("_hash", "_cuts", "_parts"))

    keys = [*TILE, "_piece", "_part"]
    # A given number of partitions is one that adaptive execution, which goes by bytes, does not merge.
    left = dealt(points, "_piece", "_cuts", "_part", "_parts").repartition(tasks, *keys)
    return left.join(dealt(tiles, "_part", "_parts", "_piece", "_cuts").repartition(tasks, *keys), keys).drop("_piece", "_part")


def stations(orders: DataFrame, districts: DataFrame, min_orders: int = MIN_CELL_ORDERS) -> DataFrame:
    """The station table, keyed by order: where two districts hold a station, the later listed wins."""
    chosen = cell_representatives(grid_cells(orders), min_orders)
    labelled = label_districts(chosen, districts, None)
    columns = ("city_id", "starting_lng", "starting_lat", "district_name")
    last = F.max_by(F.struct(*columns), "district_position").alias("last")
    return (labelled.groupBy("order_id").agg(last)
            .select("order_id", *[f"last.{c}" for c in columns]))


def query_stations(table: DataFrame, city: str | None = None, district: str | None = None) -> DataFrame:
    """Stations, optionally of one city and one district."""
    for column, wanted in (("city_id", city), ("district_name", district)):
        if wanted:
            table = table.where(F.col(column) == wanted)
    return table.select("city_id", "district_name", "starting_lng", "starting_lat")


def station_counts(table: DataFrame, city: str) -> DataFrame:
    return (table.where(F.col("city_id") == city).groupBy("district_name")
            .agg(F.count("*").alias("station_count")))


def station_sample(table: DataFrame, n: int = 100) -> DataFrame:
    """The first stations for display."""
    return table.orderBy("order_id").limit(n)


def polygon_rings(districts: DataFrame) -> DataFrame:
    """Ring points of each district in order, with the ring's text form."""
    kept = districts.where(F.coalesce(F.col("polygon"), F.lit("")) != "")
    return (kept.select("name", geo.polygon_wkt(F.col("polygon")).alias("wkt"),
                        F.posexplode(geo.ring_points(F.col("polygon"))).alias("seq", "point"))
            .select("name", "wkt", "seq", "point.lng", "point.lat"))


def district_rows(documents: DataFrame) -> DataFrame:
    """(citycode, name, polygon) rows of parsed district documents.

    A city's districts are walked one level down. With a ``wanted`` city code the walk of a list
    stops at its first match; without one every district is returned.
    """
    wanted, listed = F.col("wanted"), F.col("document.districts")

    def matches(d: Column) -> Column:
        return ((d["level"] == "district") & d["polyline"].isNotNull()
                & (wanted.isNull() | (d["citycode"] == wanted)))

    def walk(nodes: Column) -> Column:
        found = F.filter(nodes, matches)
        return F.when(wanted.isNull(), found).otherwise(F.slice(found, 1, 1))

    # With a wanted code nothing behind the first match of the top list is visited.
    stop = F.array_position(F.transform(listed, matches), True)
    visited = F.when(wanted.isNull() | (stop == 0), listed).otherwise(F.slice(listed, F.lit(1), stop))
    own = F.transform(
        F.filter(visited, lambda d: d["level"] == "district"),
        lambda d: F.struct(d["name"], d["citycode"], d["polyline"], d["level"]))
    inner = F.transform(
        F.filter(visited, lambda d: d["level"] == "city"), lambda d: walk(d["districts"]))
    return (documents.select(F.inline(F.concat(walk(own), F.flatten(inner))))
            .select("citycode", "name", F.col("polyline").alias("polygon")))


def geojson_rings(collections: DataFrame) -> DataFrame:
    """Feature collections -> one row per ring: feature name, polygon and ring number, points."""
    features = collections.select(F.explode("features").alias("f"))
    polygons = features.select(F.col("f.properties.name").alias("name"),
                               F.posexplode("f.geometry.coordinates").alias("polygon_no", "polygon"))
    rings = polygons.select("name", "polygon_no", F.posexplode("polygon").alias("ring_no", "ring"))
    return rings.select("name", "polygon_no", "ring_no", F.transform(
        "ring", lambda p: F.struct(p[0].alias("lng"), p[1].alias("lat"))).alias("points"))
