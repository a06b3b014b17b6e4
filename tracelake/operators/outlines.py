"""Outlines: lines grown to polygons, fewer corners, unions of boxes and of cells."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions.geo import METRES_PER_DEGREE
from tracelake.operators.boxes import cells

QUARTER = 16  # corners of a quarter of a round cap
BUFFER, TOLERANCE, LEAST_AREA = 10.0, 2.0, 0.1  # metres, metres and square metres


def grown(line: np.ndarray, radius: float) -> np.ndarray:
    """Ring around a line at a distance, round at its ends and at outer corners; of an inner corner the offset lines' meeting, or, next to a short segment, the corner itself."""
    line = line[np.concatenate([[True], (np.diff(line, axis=0) != 0).any(axis=1)])]
    fan = lambda p, start, sweep: p + radius * np.stack([np.cos(a := start - np.linspace(0, sweep, max(2, math.ceil(sweep / (math.pi / 2) * QUARTER) + 1))), np.sin(a)], axis=1)
    if len(line) == 1:
        return fan(line[0], 0.0, 2 * math.pi)[:-1]

    def side(p: np.ndarray) -> list[np.ndarray]:
        """The left side from start to end, and the cap there."""
        step = np.diff(p, axis=0)
        size = np.hypot(*step.T)
        normal = np.stack([-step[:, 1], step[:, 0]], axis=1) / size[:, None]
        angle = np.arctan2(normal[:, 1], normal[:, 0])
        out = [p[:1] + radius * normal[:1]]
        for i in range(1, len(step)):
            a, b = normal[i - 1], normal[i]
            sweep = (angle[i - 1] - angle[i]) % (2 * math.pi)
            if 0 < sweep <= math.pi:  # turns right: the left side is the outer one
                out.append(fan(p[i], angle[i - 1], sweep))
                continue
            cosine = float(a @ b)
            reach = radius * math.sqrt(max(0.0, (1 - cosine) / (1 + cosine))) if cosine > -1 else math.inf
            if reach <= min(size[i - 1], size[i]):
                out.append((p[i] + radius * (a + b) / (1 + cosine))[None])
            else:
                out.append(np.stack([p[i] + radius * a, p[i], p[i] + radius * b]))
        return [*out, fan(p[-1], angle[-1], math.pi)]

    return np.concatenate([*side(line), *side(line[::-1])])


def simplified(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Which points stay when those no further than ``tolerance`` from the line between kept ones go (farthest first); runs that are still open wait on a stack."""
    keep = np.zeros(len(points), bool)
    keep[[0, -1]] = True
    open_ = [(0, len(points) - 1)]
    while open_:
        i, j = open_.pop()
        if j - i < 2:
            continue
        start, d, some = points[i], points[j] - points[i], points[i + 1 : j]
        size = float(d @ d)
        t = np.clip((some - start) @ d / size, 0, 1) if size else np.zeros(len(some))
        off = np.hypot(*(some - start - t[:, None] * d).T)
        far = int(off.argmax())
        if off[far] > tolerance:
            keep[i + 1 + far] = True
            open_ += [(i, i + 1 + far), (i + 1 + far, j)]
    return keep


def area(ring: np.ndarray) -> float:
    x, y = (ring - ring[0]).T  # far from the origin products would lose digits
    return abs(float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum())) / 2


def line_polygon(line: np.ndarray, radius: float, tolerance: float, least: float) -> np.ndarray | None:
    """A line's ring with fewer corners; as it was where too little would be left; None for one of too small an area."""
    ring = grown(line, radius)
    if area(ring) < least:
        return None
    closed = np.concatenate([ring, ring[:1]])
    few = closed[simplified(closed, tolerance)][:-1]
    return few if len(few) > 2 and area(few) >= least else ring


def line_polygons(lines: DataFrame, radius: float = BUFFER, tolerance: float = TOLERANCE, least: float = LEAST_AREA) -> DataFrame:
    """``lines`` with ``ring``, all that lies within ``radius`` metres, and its ``area`` in square metres.

    ``tolerance`` and ``least`` are metres and square metres as well, all of ``METRES_PER_DEGREE``. Null and empty lines,
    and rings under ``least``, are left out; a line of one place becomes a circle. A line that comes back to itself gives
    a ring that overlaps itself.
    """
    unit = METRES_PER_DEGREE

    @F.pandas_udf("struct<ring:array<struct<x:double,y:double>>,area:double>")
    def made(line: pd.Series) -> pd.DataFrame:
        rings, areas = [], []
        for points in line:
            places = np.array([(p["lon"], p["lat"]) for p in points if p["lon"] is not None and p["lat"] is not None], float).reshape(-1, 2) if points is not None else np.zeros((0, 2))
            ring = line_polygon(places * unit, radius, tolerance, least) if len(places) else None
            rings.append(None if ring is None else [{"x": x, "y": y} for x, y in (ring / unit).tolist()])
            areas.append(None if ring is None else area(ring))
        return pd.DataFrame({"ring": rings, "area": areas})

    return lines.withColumn("made", made("line")).where("made.ring is not null").select(*lines.columns, "made.ring", "made.area")


def union_of_boxes(boxes: DataFrame, *keys: str, size: float = 0.002) -> DataFrame:
    """``keys, area, lon, lat``: area and centroid of the union of each group's envelopes, in degrees; what several cover counts once.

    Boxes are clipped to grid cells; a cell is cut in strips at all left and right sides of its boxes, and a strip's
    part of the union is the running union of its boxes from below. Groups of no area have none and no row.
    """
    by = [*keys, "gx", "gy"]
    edge = lambda g, d: (F.col(g) + d) * F.lit(size)
    clipped = cells(boxes.select(*keys, "xmin", "ymin", "xmax", "ymax"), size).select(
        *by, F.greatest("xmin", edge("gx", 0)).alias("xmin"), F.least("xmax", edge("gx", 1)).alias("xmax"), F.greatest("ymin", edge("gy", 0)).alias("ymin"), F.least("ymax", edge("gy", 1)).alias("ymax")
    ).where("xmax > xmin and ymax > ymin").distinct()
    sides = clipped.select(*by, F.col("xmin").alias("x")).unionByName(clipped.select(*by, F.col("xmax").alias("x"))).distinct()
    strips = sides.withColumn("to", F.lead("x").over(Window.partitionBy(*by).orderBy("x"))).where("to is not null")
    held = clipped.join(strips, by).where("xmin <= x and xmax >= to")
    before = F.max("ymax").over(Window.partitionBy(*by, "x").orderBy("ymin", "ymax").rowsBetween(Window.unboundedPreceding, -1))
    held = held.withColumn("low", F.greatest("ymin", F.coalesce(before, F.col("ymin")))).where("ymax > low")
    part = held.withColumn("part", (F.col("to") - F.col("x")) * (F.col("ymax") - F.col("low")))
    return part.groupBy(*keys).agg(
        F.sum("part").alias("area"), (F.sum(F.col("part") * (F.col("x") + F.col("to")) / 2) / F.sum("part")).alias("lon"), (F.sum(F.col("part") * (F.col("low") + F.col("ymax")) / 2) / F.sum("part")).alias("lat")
    )


def outline_of_cells(found: DataFrame, *keys: str, size: float = 0.002) -> DataFrame:
    """``keys, cell_count, area, perimeter, shape_complexity`` of sets of distinct cells ``(grid_x, grid_y)``: a side that two cells share is inside and cancels.

    Complexity is the perimeter over that of a circle of the same area.
    """
    x, y = F.col("grid_x"), F.col("grid_y")
    side = lambda a, b, upright: F.struct(a.alias("x"), b.alias("y"), F.lit(upright).alias("upright"))
    sides = found.select(*keys, F.explode(F.array(side(x, y, True), side(x + 1, y, True), side(x, y, False), side(x, y + 1, False))).alias("side"))
    once = sides.groupBy(*keys, "side").agg(F.count("*").alias("n")).groupBy(*keys).agg((F.count_if(F.col("n") == 1) * F.lit(size)).alias("perimeter"))
    counted = found.groupBy(*keys).agg(F.count("*").alias("cell_count")).withColumn("area", F.col("cell_count") * F.lit(size * size))
    return counted.join(once, list(keys)).withColumn("shape_complexity", F.col("perimeter") / (2 * F.sqrt(F.lit(math.pi) * F.col("area"))))
