"""Grids and polygons."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfare.constants import HEX_EDGE_M, HEX_RESOLUTION, METRES_PER_DEGREE, SQUARE_EDGE_M


def hex_axial(lat: Column, lng: Column, edge_m: float = HEX_EDGE_M) -> tuple[Column, Column]:
    """Axial (q, r) of the hexagon holding a point.

    The three floors below are the strips the point lies in along the three hexagon axes; two
    differences of strips, divided by three, give the nearest centre. This equals rounding the
    cube coordinates and repairing the worst one, without the nested CASE that Catalyst would copy
    into every place the cell is used. Malformed coordinates give a null cell.
    """
    x = lng.try_cast("double") * F.lit(METRES_PER_DEGREE * math.sqrt(3.0) / 3.0 / edge_m)
    y = lat.try_cast("double") * F.lit(METRES_PER_DEGREE / edge_m)
    falling, rising, across = F.floor(x - y), F.floor(x + y), F.floor(x * F.lit(-2.0))
    third = F.lit(3.0)
    return (F.floor((falling - across + F.lit(1)) / third),
            F.floor((rising - falling + F.lit(1)) / third))


def packed(q: Column, r: Column) -> Column:
    return q * F.lit(1 << 32) + r


def unpacked(cell: Column) -> tuple[Column, Column]:
    """Axial (q, r) of a packed cell."""
    r = F.pmod(cell + F.lit(1 << 31), F.lit(1 << 32)) - F.lit(1 << 31)
    return F.shiftright(cell - r, 32), r


# The six neighbours of the middle cell of a parent, by the number that ``q + 5r`` leaves when divided by seven, after the middle itself.
_NEIGHBOURS = ((0, 0), (1, 0), (0, -1), (1, -1), (-1, 1), (0, 1), (-1, 0))


def _parent(q: Column, r: Column) -> tuple[Column, Column]:
    place = F.pmod(q + r * 5, F.lit(7)).cast("int")
    q = q - F.get(F.array(*[F.lit(n[0]) for n in _NEIGHBOURS]), place)
    r = r - F.get(F.array(*[F.lit(n[1]) for n in _NEIGHBOURS]), place)
    # The middles of parents lie at Q * (2, 1) + R * (-1, 3).
    return F.floor((q * 3 + r) / 7), F.floor((r * 2 - q) / 7)


def cell_parent(cell: Column, steps: int = 1) -> Column:
    """The cell ``steps`` resolutions coarser that a cell belongs to.

    Seven cells, one and its neighbours, make a parent, whose edge is sqrt(7) times theirs. Every cell has one parent, so
    counts of coarser cells are sums over finer ones.
    """
    if steps == 0:
        return cell
    # A loop over the steps: written out, each step would hold several copies of the one before.
    q, r = unpacked(cell)
    return F.aggregate(F.array_repeat(F.lit(0), steps), F.struct(q.alias("q"), r.alias("r")),
                       lambda at, _: F.struct(*[c.alias(n) for c, n in zip(_parent(at["q"], at["r"]), "qr", strict=True)]),
                       lambda at: packed(at["q"], at["r"]))


def cell_children(cell: Column) -> Column:
    """The seven cells of a cell, one resolution finer, the middle one first."""
    q, r = unpacked(cell)
    return F.array(*[packed(q * 2 - r + dq, q + r * 3 + dr) for dq, dr in _NEIGHBOURS])


def hex_edge(resolution: int) -> float:
    """Edge in metres at a resolution."""
    return HEX_EDGE_M * math.sqrt(7.0) ** (HEX_RESOLUTION - resolution)


def hex_cell(lat: Column, lng: Column, edge_m: float = HEX_EDGE_M, resolution: int = HEX_RESOLUTION) -> Column:
    """Hexagon of a point packed in one bigint, ``q * 2^32 + r``.

    ``resolution`` may be coarser than that of ``edge_m``, ``HEX_RESOLUTION``: then it is the parent so many steps up.
    """
    if resolution > HEX_RESOLUTION:
        raise ValueError(f"cells are at most of resolution {HEX_RESOLUTION}; give a shorter edge instead")
    return cell_parent(packed(*hex_axial(lat, lng, edge_m)), HEX_RESOLUTION - resolution)


def square_cell(degrees: Column) -> Column:
    """Square-grid index of a latitude or longitude; half is rounded to even."""
    return F.bround(degrees * F.lit(111) * F.lit(1000) / F.lit(SQUARE_EDGE_M)).cast("int")


def ring_points(polygon: Column) -> Column:
    """``lng,lat;lng,lat;...`` -> array of (lng, lat)."""
    return F.transform(
        F.split(polygon, ";"),
        lambda p: F.struct(
            F.get(F.split(p, ","), F.lit(0)).try_cast("double").alias("lng"),
            F.get(F.split(p, ","), F.lit(1)).try_cast("double").alias("lat")))


def polygon_wkt(polygon: Column) -> Column:
    return F.concat(F.lit("POLYGON(("), F.translate(polygon, ",;", " ,"), F.lit("))"))


def point_wkt(lng: Column, lat: Column) -> Column:
    return F.concat(F.lit("POINT("), lng, F.lit(" "), lat, F.lit(")"))


def ring_edges(points: Column) -> Column:
    """Consecutive point pairs of a ring as (x1, y1, x2, y2)."""
    return F.zip_with(
        F.slice(points, F.lit(1), F.size(points) - 1),
        F.slice(points, F.lit(2), F.size(points) - 1),
        lambda a, b: F.struct(a["lng"].alias("x1"), a["lat"].alias("y1"),
                              b["lng"].alias("x2"), b["lat"].alias("y2")))


def inside_ring(lng: Column, lat: Column, edges: Column) -> Column:
    """Strict interior: an odd number of edges crosses the ray and none touches the point."""
    def crosses(e: Column) -> Column:
        straddles = (e["y1"] > lat) != (e["y2"] > lat)
        rise = F.nullif(e["y2"] - e["y1"], F.lit(0.0))
        return straddles & (lng < (e["x2"] - e["x1"]) * (lat - e["y1"]) / rise + e["x1"])

    def touches(e: Column) -> Column:
        cross = (e["x2"] - e["x1"]) * (lat - e["y1"]) - (e["y2"] - e["y1"]) * (lng - e["x1"])
        return ((cross == 0.0)
                & lng.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
                & lat.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])))

    return (F.size(F.filter(edges, crosses)) % 2 == 1) & ~F.exists(edges, touches)
