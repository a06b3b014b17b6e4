"""Roads and lanes: chains, nearest lanes, lane hits, polygons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions.geo import METRES_PER_DEGREE, bearing, clipped_fraction, heading_difference, point_segment_distance
from tracelake.operators.boxes import BOX, box_join, cell_join, folded, unfolded


def chains(edges: DataFrame, seeds: DataFrame, limit: float, depth: int = 10, backward: bool = False) -> DataFrame:
    """Roads reached from ``seeds(roadid)``: distinct ``(road_id, depth, distance)``.

    A seed's edges lead to roads at distance 0; going on from a road adds the length of the edge that led
    to it (null counts 0), while the sum stays within ``limit``. Depth bounds cycles; one join a level, each
    over the distinct roads and distances of the last level, so that paths that meet go on as one.
    """
    start, end = ("nextroadid", "roadid") if backward else ("roadid", "nextroadid")
    e = edges.select(F.col(start).alias("a"), F.col(end).alias("road_id"), F.coalesce("length", F.lit(0.0)).alias("length"))
    level = e.join(seeds.select(F.col("roadid").alias("a")), "a", "left_semi").select("road_id", F.lit(0).alias("depth"), F.lit(0.0).alias("distance"), "length")
    out = level
    for d in range(1, depth + 1):
        level = level.select(F.col("road_id").alias("a"), (F.col("distance") + F.col("length")).alias("distance")).where(F.col("distance") <= limit).distinct()
        level = level.join(e, "a").select("road_id", F.lit(d).alias("depth"), "distance", "length")
        out = out.unionByName(level)
    return out.drop("length").distinct()


def merged_roads(**kinds: DataFrame) -> DataFrame:
    """One row ``(road_id, kind)`` for each road: the first of the named kinds, in order, that has it."""
    out = None
    for n, (kind, roads) in enumerate(kinds.items()):
        rows = roads.select("road_id", F.lit(n).alias("nth"), F.lit(kind).alias("kind"))
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("road_id").agg(F.min_by("kind", "nth").alias("kind"))


def nearest_rows(chain: DataFrame) -> DataFrame:
    """One row for each road: the least depth, then distance."""
    w = Window.partitionBy("road_id").orderBy("depth", "distance")
    return chain.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


def lane_distance(lon: str = "lon", lat: str = "lat") -> Column:
    return point_segment_distance(F.col(lon), F.col(lat), F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"))


def near_lanes(points: DataFrame, lanes: DataFrame, metres: float, size: float | None = None, key: list[str] | None = None, k: int = 0, tie: str = "lane_id") -> DataFrame:
    """Pairs of points and lanes (two-point lines) no further apart than ``metres`` (degrees over 111320), with ``distance``.

    Lanes are dealt to the cells of their envelope grown by the radius; a point is in one cell, cells are about as
    wide as the radius. Lanes of one line are measured once. With ``k``, the ``k`` nearest lanes of each point
    ``key``, numbered by ``nth``: a point's pairs all lie in its cell, so that they are ranked where the join has put
    them; of lanes of one line only the ``k`` first by ``tie`` can be among them.
    """
    radius = metres / METRES_PER_DEGREE
    size = size or max(radius, 0.00025)
    at = lambda c, d: F.floor((F.col(c) + d) / size).cast("long")
    if k:
        first = F.row_number().over(Window.partitionBy(*BOX).orderBy(tie))
        lanes = lanes.withColumn("nth", first).where(F.col("nth") <= k).drop("nth")
    else:
        lanes = folded(lanes)
    dealt = lanes.withColumn("gx", F.explode(F.sequence(at("xmin", -radius), at("xmax", radius)))).withColumn("gy", F.explode(F.sequence(at("ymin", -radius), at("ymax", radius))))
    points = points.withColumns({"gx": at("lon", 0.0), "gy": at("lat", 0.0)})
    found = points.join(dealt.hint("merge"), ["gx", "gy"]) if k else cell_join(points, dealt, ["gx", "gy"])
    found = found.withColumn("distance", lane_distance()).where(F.col("distance") <= radius)
    if k:
        w = Window.partitionBy("gx", "gy", *key).orderBy("distance", tie)
        found = found.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= k)
        return found.drop("gx", "gy")
    return unfolded(found.drop("gx", "gy"), "")


def lane_classes(lanes: DataFrame) -> DataFrame:
    """Lanes of equal lines as one: ``lane_id``, the least of them, and ``lanes``, how many they are. Lanes of several lines stay as they are."""
    rows = lanes.select("lane_id", *BOX).dropna(subset=BOX).withColumn("alone", (F.count("*").over(Window.partitionBy("lane_id")) == 1) & F.col("lane_id").isNotNull())
    same = rows.where("alone").groupBy(*BOX).agg(F.min("lane_id").alias("lane_id"), F.count("*").alias("lanes"))
    return same.unionByName(rows.where("not alone").select("lane_id", *BOX, F.col("lane_id").isNotNull().cast("long").alias("lanes")))


def touched_lanes(points: DataFrame, lanes: DataFrame, metres: float) -> DataFrame:
    """Distinct ``dataset_name`` and lines of lanes no further than ``metres`` from a point."""
    return near_lanes(points.select("dataset_name", "lon", "lat"), lanes.select(*BOX).distinct().withColumn("n", F.lit(1)), metres).select("dataset_name", *BOX).distinct()


def touched_boxes(points: DataFrame, boxes: DataFrame, metres: float) -> DataFrame:
    """Distinct ``dataset_name`` and envelopes no further than ``metres`` from a point."""
    at = points.select("dataset_name", F.col("lon").alias("xmin"), F.col("lat").alias("ymin"), F.col("lon").alias("xmax"), F.col("lat").alias("ymax"))
    met = box_join(at, boxes.select(*BOX).distinct(), how="dwithin", distance=metres / METRES_PER_DEGREE)
    return met.select(F.col("l_dataset_name").alias("dataset_name"), *[F.col(f"r_{c}").alias(c) for c in BOX]).distinct()


def named(touched: DataFrame, objects: DataFrame, key: str) -> DataFrame:
    """Distinct ``(dataset_name, key)`` of touched envelopes; only those of objects with several envelopes can repeat."""
    own = objects.select(*BOX, key).distinct().withColumn("once", F.count("*").over(Window.partitionBy(key)) == 1)
    pairs = cell_join(touched, own, BOX).select("dataset_name", key, "once")
    return pairs.where("once").drop("once").unionByName(pairs.where("not once").drop("once").distinct())


def lane_heading() -> Column:
    return bearing(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"))


def same_direction(a: Column, b: Column, most: float = 45.0) -> Column:
    return heading_difference(a, b) <= most


def lane_counts(hits: DataFrame) -> DataFrame:
    """``(dataset_name, total_points, lane_count)`` of pairs of points and lanes, or of lines of ``lanes`` lanes (``lane_classes``)."""
    n = F.col("lanes") if "lanes" in hits.columns else F.col("lane_id").isNotNull().cast("long")
    per = hits.groupBy("dataset_name", "lane_id").agg(F.count("*").alias("points"), F.max(n).alias("n"))
    return per.groupBy("dataset_name").agg(F.sum(F.col("points") * F.greatest("n", F.lit(1))).alias("total_points"), F.sum("n").alias("lane_count"))


def lane_rules(hits: DataFrame, lanes: int = 2, points: int = 5) -> DataFrame:
    """Datasets that touch two lanes or more, or have five points or more on one; with the reason."""
    h = lane_counts(hits)
    many = F.col("lane_count") >= lanes
    reason = F.when(many, F.concat(F.lit("multi_lane_"), "lane_count", F.lit("_lanes"))).when(F.col("total_points") >= points, F.concat(F.lit("sufficient_points_"), "total_points", F.lit("_points")))
    return h.withColumn("reason", reason).where("reason is not null")


def line_in_box(p: str = "b_") -> Column:
    """Share of a lane that lies in a box with prefixed corners."""
    return clipped_fraction(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"), *[F.col(f"{p}{c}") for c in ("xmin", "ymin", "xmax", "ymax")])


def link_flags(objects: DataFrame, keys: list[str], **links: DataFrame) -> DataFrame:
    """A boolean for each link table: does it hold the object's (composite) key? Link rows are deduplicated first."""
    for name, link in links.items():
        objects = objects.join(link.select(*keys).distinct().withColumn(name, F.lit(True)), keys, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return objects


def lane_availability(lanes: DataFrame, analysis, most: int = 5) -> DataFrame:
    """``analysis_id, lane_count, asked``: the lanes of the asked analysis; where it has none, the ``most`` analyses of most lanes (ties by id)."""
    counts = lanes.groupBy("analysis_id").agg(F.count("*").alias("lane_count"))
    own = counts.where(F.col("analysis_id") == F.lit(analysis)).withColumn("asked", F.lit(True))
    top = counts.orderBy(F.desc("lane_count"), "analysis_id").limit(most).withColumn("asked", F.lit(False))
    return own.unionByName(top.join(F.broadcast(own.select("asked").limit(1).withColumnRenamed("asked", "found")), F.col("found"), "left_anti"))


def road_summary(roads: DataFrame) -> DataFrame:
    """By ``analysis_id`` of ``(analysis_id, road_id, kind, lane_count, length)``: distinct roads, those of each kind, lanes and length."""
    kinds = [F.count_if(F.col("kind") == k).alias(f"{k}_roads") for k in ("direct", "chain", "intersection")]
    return roads.groupBy("analysis_id").agg(F.countDistinct("road_id").alias("total_roads"), *kinds, F.sum("lane_count").alias("total_lanes"), F.round(F.sum("length"), 3).alias("total_length"))
