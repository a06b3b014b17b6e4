"""Whether polygons and lines are sound, why not, and what can be mended."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.operators.polygons import CELL, crossed, edges_of, level_of, odd, on_border


def steps(points: Column) -> Column:
    """Points without those equal to the one before."""
    return F.filter(points, lambda p, i: (i == 0) | (p != F.get(points, i - 1)))


def signed_area(ring: Column) -> Column:
    """Positive for a ring that turns left."""
    return F.aggregate(edges_of(ring), F.lit(0.0), lambda a, e: a + (e["x1"] * e["y2"] - e["x2"] * e["y1"])) / 2


def turn(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    """-1, 0 or 1: on which side of a to b the place c lies."""
    return F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def self_crossings(polygons: DataFrame) -> DataFrame:
    """Ids of polygons of which two edges meet where they must not.

    Edges of one ring share nothing but the corner between neighbours; those of different rings may touch in a place
    but neither cross nor run along each other. A shape's own edges are dealt to cells, and only those of a cell
    are compared: cells are as many as edges, or more.
    """
    each = polygons.select("polygon_id", level_of(F.col("rings")).alias("level"), F.posexplode("rings").alias("r", "ring")).where("size(ring) > 2")
    edges = each.select("polygon_id", "level", "r", F.size("ring").alias("n"), F.posexplode(edges_of(F.col("ring"))).alias("k", "e")).select("polygon_id", "level", "r", "n", "k", "e.*")
    dealt = crossed(edges.where("x1 <> x2 or y1 <> y2")).withColumn("gx", F.explode(F.sequence("gx_from", "gx_to"))).drop("gx_from", "gx_to")
    key = ["polygon_id", *CELL]
    a, b = (dealt.select(*key, *[F.col(c).alias(f"{p}{c}") for c in ("r", "n", "k", "x1", "y1", "x2", "y2")]) for p in "ab")
    c = F.col
    side = lambda p, q, end: turn(c(f"{p}x1"), c(f"{p}y1"), c(f"{p}x2"), c(f"{p}y2"), c(f"{q}x{end}"), c(f"{q}y{end}"))
    s1, s2, s3, s4 = side("a", "b", 1), side("a", "b", 2), side("b", "a", 1), side("b", "a", 2)
    overlap = lambda v: (F.greatest(F.least(f"a{v}1", f"a{v}2"), F.least(f"b{v}1", f"b{v}2")), F.least(F.greatest(f"a{v}1", f"a{v}2"), F.greatest(f"b{v}1", f"b{v}2")))
    (x_from, x_to), (y_from, y_to) = overlap("x"), overlap("y")
    in_line = (s1 == 0) & (s2 == 0)
    boxes_meet = (x_from <= x_to) & (y_from <= y_to)
    along = in_line & boxes_meet & ((x_from < x_to) | (y_from < y_to))
    cross = (s1 * s2 < 0) & (s3 * s4 < 0)
    touch = boxes_meet & (s1 * s2 <= 0) & (s3 * s4 <= 0)
    next_ = (c("ar") == c("br")) & ((c("bk") == c("ak") + 1) | ((c("ak") == 0) & (c("bk") == c("an") - 1)))
    bad = F.when(next_, along).when(c("ar") == c("br"), touch).otherwise(cross | along)
    ordered = (c("ar") < c("br")) | ((c("ar") == c("br")) & (c("ak") < c("bk")))
    return a.join(b.hint("merge"), key).where(ordered & bad).select("polygon_id").distinct()


def checked_polygons(polygons: DataFrame) -> DataFrame:
    """``polygons(polygon_id, rings)``, the first ring the outer one, with ``reasons`` and mended ``rings``.

    Mended: rings are closed, equal neighbours dropped, outer rings turn left and holes right; ``reasons`` tells
    ``unclosed``, ``repeated_points`` and ``orientation``. ``valid`` is false for what stays wrong: ``too_few_points`` (under
    three places), ``self_intersection`` and ``hole_outside`` (a hole's first place isn't within the outer ring).
    No rings are too few points.
    """
    opened = lambda r: F.when((F.size(r) > 1) & (F.get(r, F.lit(0)) == F.element_at(r, -1)), F.slice(r, 1, F.greatest(F.size(r) - 1, F.lit(1)))).otherwise(r)
    given = polygons.select("polygon_id", F.col("rings").alias("raw"), F.transform("rings", lambda r: opened(steps(r))).alias("rings"))
    crossing = self_crossings(given.select("polygon_id", "rings")).withColumn("crosses", F.lit(True))
    rows = given.join(crossing.hint("merge"), "polygon_id", "left")
    outer = F.get("rings", F.lit(0))
    left = lambda r, i: F.when((signed_area(r) > 0) == (i == 0), r).otherwise(F.reverse(r))
    mended = F.transform("rings", lambda r, i: F.concat(left(r, i), F.slice(left(r, i), 1, 1)))
    held = lambda r: odd(F.get(r, F.lit(0))["x"], F.get(r, F.lit(0))["y"], edges_of(outer)) | on_border(F.get(r, F.lit(0))["x"], F.get(r, F.lit(0))["y"], F.filter(edges_of(outer), lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"])))
    reasons = {
        "too_few_points": (F.size("rings") < 1) | F.exists("rings", lambda r: F.size(r) < 3),
        "self_intersection": F.coalesce("crosses", F.lit(False)),
        "hole_outside": F.exists(F.slice("rings", 2, F.greatest(F.size("rings") - 1, F.lit(0))), lambda r: (F.size(r) > 0) & ~held(r)),
        "unclosed": F.exists("raw", lambda r: (F.size(r) > 0) & (F.get(r, F.lit(0)) != F.element_at(r, -1))),
        "repeated_points": F.exists("raw", lambda r: F.size(steps(r)) < F.size(r)),
        "orientation": F.exists(F.transform("rings", lambda r, i: (signed_area(r) > 0) != (i == 0)), lambda x: x),
    }
    rows = rows.withColumn("reasons", F.array_compact(F.array(*[F.when(test, name) for name, test in reasons.items()])))
    wrong = F.arrays_overlap("reasons", F.array(*[F.lit(x) for x in ("too_few_points", "self_intersection", "hole_outside")]))
    return rows.select("polygon_id", F.when(wrong, F.col("raw")).otherwise(mended).alias("rings"), "reasons", (~wrong).alias("valid"))


def checked_lines(lines: DataFrame) -> DataFrame:
    """``lines`` with equal neighbours dropped from ``line``, and ``valid``: whether two places are left."""
    return lines.withColumn("line", steps(F.col("line"))).withColumn("valid", F.coalesce(F.size("line") > 1, F.lit(False)))
