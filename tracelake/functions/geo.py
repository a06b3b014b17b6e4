"""Geometry as column expressions: envelopes are four doubles, lines arrays of ``struct<lon,lat>``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on: earth radius in metres, and metres in a degree by operator.
EARTH_RADIUS = 6371000.0
METRES_PER_DEGREE = 111320.0
METRES_PER_DEGREE_AREA = 111000.0


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres."""
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon) * F.sin(dlon)
    return F.lit(2 * EARTH_RADIUS) * F.asin(F.sqrt(F.when(a > 1, 1.0).otherwise(a)))  # least() would skip a null


def bearing(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Initial heading in degrees, 0 to 360."""
    a, b, d = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    return F.pmod(F.degrees(F.atan2(F.sin(d) * F.cos(b), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d))) + 360, F.lit(360.0))


def heading_difference(a: Column, b: Column) -> Column:
    d = F.abs(a - b)
    return F.least(d, 360 - d)


def overlaps(a: str, b: str) -> Column:
    """Envelopes ``a`` and ``b`` (column prefixes) share a point; borders count."""
    return (F.col(f"{a}xmin") <= F.col(f"{b}xmax")) & (F.col(f"{a}xmax") >= F.col(f"{b}xmin")) & (F.col(f"{a}ymin") <= F.col(f"{b}ymax")) & (F.col(f"{a}ymax") >= F.col(f"{b}ymin"))


def contains(a: str, b: str) -> Column:
    """Envelope ``a`` holds all of ``b``."""
    return (F.col(f"{a}xmin") <= F.col(f"{b}xmin")) & (F.col(f"{a}xmax") >= F.col(f"{b}xmax")) & (F.col(f"{a}ymin") <= F.col(f"{b}ymin")) & (F.col(f"{a}ymax") >= F.col(f"{b}ymax"))


def within_distance(a: str, b: str, degrees: float) -> Column:
    """Envelopes are no further apart than ``degrees``."""
    dx = F.greatest(F.lit(0.0), F.col(f"{a}xmin") - F.col(f"{b}xmax"), F.col(f"{b}xmin") - F.col(f"{a}xmax"))
    dy = F.greatest(F.lit(0.0), F.col(f"{a}ymin") - F.col(f"{b}ymax"), F.col(f"{b}ymin") - F.col(f"{a}ymax"))
    return dx * dx + dy * dy <= degrees * degrees


def point_segment_distance(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Planar distance from a point to a segment, in the coordinates' unit."""
    dx, dy = x2 - x1, y2 - y1
    length = dx * dx + dy * dy
    t = F.when(length > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - x1) * dx + (y - y1) * dy) / F.nullif(length, F.lit(0.0))))).otherwise(F.lit(0.0))
    ex, ey = x - (x1 + t * dx), y - (y1 + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def clipped_fraction(x1: Column, y1: Column, x2: Column, y2: Column, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Share of a segment that lies in an envelope (Liang-Barsky)."""
    dx, dy = x2 - x1, y2 - y1
    enter, leave, miss = [F.lit(0.0)], [F.lit(1.0)], []
    for p, q in ((-dx, x1 - xmin), (dx, xmax - x1), (-dy, y1 - ymin), (dy, ymax - y1)):
        r = q / F.nullif(p, F.lit(0.0))
        enter.append(F.when(p < 0, r))
        leave.append(F.when(p > 0, r))
        miss.append((p == 0) & (q < 0))
    share = F.least(*leave) - F.greatest(*enter)
    return F.when(reduce(lambda a, b: a | b, miss), 0.0).otherwise(F.greatest(F.lit(0.0), share))


def iou(a: str, b: str) -> Column:
    """Intersection over union of two envelopes."""
    w = F.greatest(F.lit(0.0), F.least(f"{a}xmax", f"{b}xmax") - F.greatest(f"{a}xmin", f"{b}xmin"))
    h = F.greatest(F.lit(0.0), F.least(f"{a}ymax", f"{b}ymax") - F.greatest(f"{a}ymin", f"{b}ymin"))
    area = lambda p: (F.col(f"{p}xmax") - F.col(f"{p}xmin")) * (F.col(f"{p}ymax") - F.col(f"{p}ymin"))
    return w * h / F.nullif(area(a) + area(b) - w * h, F.lit(0.0))


def shoelace(ring: Column) -> Column:
    """Area of a ring of ``struct<x,y>``, open or closed."""
    n = F.size(ring)
    term = lambda i: F.get(ring, i)["x"] * F.get(ring, (i + 1) % n)["y"] - F.get(ring, (i + 1) % n)["x"] * F.get(ring, i)["y"]
    return F.abs(F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), lambda acc, i: acc + term(i))) / 2


def wkt_line(points: Column) -> Column:
    """``LINESTRING (lon lat, ...)`` of an array of ``struct<lon,lat>``."""
    return F.concat(F.lit("LINESTRING ("), F.array_join(F.transform(points, lambda p: F.concat_ws(" ", p["lon"].cast("string"), p["lat"].cast("string"))), ", "), F.lit(")"))


def wkt_envelope(p: str = "") -> Column:
    corner = lambda x, y: F.concat_ws(" ", F.col(f"{p}{x}").cast("string"), F.col(f"{p}{y}").cast("string"))
    ring = [("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"), ("xmin", "ymin")]
    return F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *[corner(x, y) for x, y in ring]), F.lit("))"))


def parse_wkt_line(wkt: Column) -> Column:
    """Array of ``struct<lon,lat>`` of a LINESTRING (a third coordinate is dropped); null for anything else."""
    body = F.regexp_extract(wkt, r"(?i)^\s*LINESTRING\s*Z?\s*\((.*)\)\s*$", 1)
    pair = lambda s: F.split(F.trim(s), r"\s+")
    points = F.transform(F.split(body, ","), lambda s: F.struct(F.try_element_at(pair(s), F.lit(1)).try_cast("double").alias("lon"), F.try_element_at(pair(s), F.lit(2)).try_cast("double").alias("lat")))
    return F.when(body != "", points)
