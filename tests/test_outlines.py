"""Outlines and soundness of shapes against plain versions."""

import math
import random

import numpy as np
import pytest

from tracelake.operators import outlines as O
from tracelake.operators import validity as V

LINES = {
    "straight": [(0, 0), (100, 0)],
    "right angle": [(0, 0), (100, 0), (100, 80)],
    "zigzag": [(0, 0), (60, 30), (120, 0), (180, 40), (260, 40)],
    "gentle": [(20 * k, 15 * math.sin(k / 3)) for k in range(20)],
    "sharp": [(0, 0), (100, 0), (30, 60)],
    "repeated": [(0, 0), (0, 0), (50, 0), (50, 0), (50, 50)],
}


def covered(line, radius, step=0.25):
    """Area of all places within a distance of a line, counted on a fine grid."""
    p = np.array(line, float)
    x, y = (np.arange(p[:, k].min() - radius, p[:, k].max() + radius, step) + step / 2 for k in (0, 1))
    at = np.stack(np.meshgrid(x, y), axis=-1)
    near = np.full(at.shape[:2], np.inf)
    for a, b in zip(p, p[1:]):  # noqa: B905
        d = b - a
        t = np.clip((at - a) @ d / max(d @ d, 1e-9), 0, 1)
        near = np.minimum(near, np.hypot(*np.moveaxis(at - a - t[..., None] * d, -1, 0)))
    return (near <= radius).sum() * step * step


@pytest.mark.parametrize("name", LINES)
def test_area_of_grown_lines(name):
    ring = O.grown(np.array(LINES[name], float), 10.0)
    assert O.area(ring) == pytest.approx(covered(LINES[name], 10.0), rel=0.01)


def plain_simplified(points, tolerance):
    def go(i, j):
        best, far = -1.0, None
        for k in range(i + 1, j):
            d = points[j] - points[i]
            t = min(1, max(0, (points[k] - points[i]) @ d / (d @ d))) if d @ d else 0
            off = math.hypot(*(points[k] - points[i] - t * d))
            if off > best:
                best, far = off, k
        return go(i, far) | go(far, j) if best > tolerance else {i, j}

    return go(0, len(points) - 1)


def test_simplified_as_the_plain_version():
    r = np.random.default_rng(5)
    for n in (2, 3, 50, 300):
        points = np.cumsum(r.standard_normal((n, 2)), axis=0)
        assert set(np.flatnonzero(O.simplified(points, 1.5)).tolist()) == plain_simplified(points, 1.5)
    far = np.stack([np.arange(100_000.0), np.zeros(100_000)], axis=1)
    assert O.simplified(far, 1.0).sum() == 2  # no recursion, however long


def test_line_polygons(spark):
    unit = 111320.0
    rows = [(k, [(x / unit, y / unit) for x, y in v]) for k, v in LINES.items()] + [("none", None), ("empty", []), ("place", [(1.0, 1.0)])]
    frame = spark.createDataFrame(rows, "line_id string, line array<struct<lon:double,lat:double>>")
    got = {r.line_id: r for r in O.line_polygons(frame).collect()}
    assert set(got) == {*LINES, "place"}
    for name in LINES:
        full = O.grown(np.array(LINES[name], float), 10.0)
        assert len(got[name].ring) < len(full) and got[name].area == pytest.approx(O.area(full), rel=0.1)
    assert got["place"].area == pytest.approx(math.pi * 100, rel=0.15)
    assert O.line_polygons(frame, least=1e9).count() == 0 and O.line_polygons(frame.limit(0)).count() == 0


def test_union_counts_overlaps_once(spark):
    r = random.Random(4)
    boxes = [("a", x := r.randint(0, 40), y := r.randint(0, 40), x + r.randint(0, 15), y + r.randint(0, 15)) for _ in range(60)] + [("b", 3, 3, 3, 9)]
    frame = spark.createDataFrame([(k, *(v * 1e-3 for v in b)) for k, *b in boxes], "city string, xmin double, ymin double, xmax double, ymax double")
    cells = {(x, y) for k, x0, y0, x1, y1 in boxes if k == "a" for x in range(x0, x1) for y in range(y0, y1)}
    (got,) = O.union_of_boxes(frame, "city", size=0.0074).collect()
    assert got.city == "a" and got.area == pytest.approx(len(cells) * 1e-6)
    assert got.lon == pytest.approx(sum(x + 0.5 for x, _ in cells) / len(cells) * 1e-3) and got.lat == pytest.approx(sum(y + 0.5 for _, y in cells) / len(cells) * 1e-3)


def test_outline_of_cells(spark):
    block = [(x, y) for x in range(3) for y in range(3) if (x, y) != (1, 1)]
    frame = spark.createDataFrame([("ring", x, y) for x, y in block] + [("one", 5, 5)] + [("two", 0, 0), ("two", 1, 1)], "k string, grid_x long, grid_y long")
    got = {r.k: (r.cell_count, round(r.perimeter / 0.002), round(r.shape_complexity, 4)) for r in O.outline_of_cells(frame, "k").collect()}
    circle = lambda n, p: round(p / (2 * math.sqrt(math.pi * n)), 4)
    assert got == {"ring": (8, 16, circle(8, 16)), "one": (1, 4, circle(1, 4)), "two": (2, 8, circle(2, 8))}


def test_polygons_are_checked(spark):
    square, hole = [(0, 0), (8, 0), (8, 8), (0, 8), (0, 0)], [(2, 2), (2, 4), (4, 4), (4, 2), (2, 2)]
    star = [(10 * math.cos(k * 4 * math.pi / 5), 10 * math.sin(k * 4 * math.pi / 5)) for k in range(5)]
    circle = [(10 * math.cos(k * math.pi / 500), 10 * math.sin(k * math.pi / 500)) for k in range(1000)]
    shapes = {
        "good": ([square, hole], set(), True), "bow": ([[(0, 0), (4, 4), (4, 0), (0, 4), (0, 0)]], {"self_intersection"}, False), "open": ([square[:-1]], {"unclosed"}, True),
        "reversed": ([square[::-1]], {"orientation"}, True), "hole the wrong way": ([square, hole[::-1]], {"orientation"}, True), "repeated": ([[square[0], *square]], {"repeated_points"}, True),
        "two places": ([[(0, 0), (1, 1), (0, 0)]], {"too_few_points"}, False), "star": ([[*star, star[0]]], {"self_intersection"}, False), "spike": ([[(0, 0), (8, 0), (8, 8), (8, 12), (8, 8), (0, 8), (0, 0)]], {"self_intersection"}, False),
        "hole outside": ([square, [(x + 20, y) for x, y in hole]], {"hole_outside"}, False), "hole across": ([square, [(6, 2), (6, 4), (12, 4), (12, 2), (6, 2)]], {"self_intersection"}, False),
        "hole touches": ([square, [(0, 2), (2, 4), (2, 2), (0, 2)]], set(), True), "touches itself": ([[(0, 0), (8, 0), (8, 8), (4, 0), (0, 8), (0, 0)]], {"self_intersection"}, False),
        "circle": ([[*circle, circle[0]]], set(), True), "none": ([], {"too_few_points"}, False),
    }
    rows = [(k, [[(float(x), float(y)) for x, y in r] for r in v[0]]) for k, v in shapes.items()]
    got = {r.polygon_id: r for r in V.checked_polygons(spark.createDataFrame(rows, "polygon_id string, rings array<array<struct<x:double,y:double>>>")).collect()}
    for name, (_, reasons, valid) in shapes.items():
        assert (set(got[name].reasons) - ({"orientation"} if not valid else set()), got[name].valid) == (reasons, valid), name
    for name in ("open", "reversed", "repeated", "hole the wrong way"):
        outer = got[name].rings[0]
        assert outer[0] == outer[-1] and len(outer) == 5 and sum(a.x * b.y - b.x * a.y for a, b in zip(outer, outer[1:])) > 0  # noqa: B905
    inner = got["hole the wrong way"].rings[1]
    assert sum(a.x * b.y - b.x * a.y for a, b in zip(inner, inner[1:])) < 0  # noqa: B905


def test_lines_are_checked(spark):
    rows = [("a", [(0.0, 0.0), (0.0, 0.0), (1.0, 1.0)]), ("b", [(0.0, 0.0), (0.0, 0.0)]), ("c", None)]
    got = {r.k: (r.valid, r.line and len(r.line)) for r in V.checked_lines(spark.createDataFrame(rows, "k string, line array<struct<lon:double,lat:double>>")).collect()}
    assert got == {"a": (True, 2), "b": (False, 1), "c": (False, None)}
