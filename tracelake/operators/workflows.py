"""Whole workflows in one plan each: polygons to trajectories, trajectories to roads and lanes, records to segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracelake.functions.geo import METRES_PER_DEGREE, bearing, heading_difference
from tracelake.functions.graph import shuffled
from tracelake.functions.text import merged_labels
from tracelake.operators import quality_check as H
from tracelake.operators import roads as R
from tracelake.operators import trajectories as T
from tracelake.operators.boxes import BOX, box_join
from tracelake.operators.polygons import in_shapes
from tracelake.operators.shapes import planar
from tracelake.sources.geojson import read_polygons, write_lines

PIECE_METRES = 50.0  # length from which an input segment is closed
HEADING_METRES = 10.0  # shorter lines have no heading
NEAR_LANES, SAME_WAY = 10, 45.0


def polygon_trajectories(points: DataFrame, polygons: DataFrame) -> DataFrame:
    """The whole trajectory of each dataset with a point in a polygon, statistics and ``polygon_ids`` (sorted) included."""
    hit = in_shapes(points.select("dataset_name", "ts", "lon", "lat"), polygons).groupBy("dataset_name").agg(F.array_sort(F.flatten(F.collect_set("members"))).alias("polygon_ids"))
    return T.build(points.join(hit.select("dataset_name"), "dataset_name", "left_semi")).join(hit, "dataset_name")


def polygon_workflow(spark: SparkSession, geojson: str, points: DataFrame, folder: str | None = None) -> DataFrame:
    """From a GeoJSON file of polygons to trajectories; with ``folder``, they are written there as GeoJSON features too."""
    found = polygon_trajectories(points, read_polygons(spark, geojson))
    if folder:
        write_lines(found, folder)
    return found


def all_roads(points: DataFrame, lanes: DataFrame, edges: DataFrame, crossings: DataFrame, metres: float = 3.0) -> DataFrame:
    """``(road_id, kind)``: roads that trajectories touch, then their chains ahead (500 m) and behind (100 m), then roads into and out of crossings they touch."""
    lines = R.touched_lanes(points, lanes, metres).select(*BOX).distinct()
    direct = lanes.join(lines, BOX, "left_semi").select(F.col("lane_id").alias("road_id")).distinct()
    seeds = direct.select(F.col("road_id").alias("roadid"))
    chain = R.chains(edges, seeds, 500.0).unionByName(R.chains(edges, seeds, 100.0, backward=True)).select("road_id").distinct()
    met = crossings.join(R.touched_boxes(points, crossings, metres).select(*BOX).distinct(), BOX, "left_semi").select(F.col("intersection_id").alias("roadid")).distinct()
    into = edges.join(met, "roadid", "left_semi").select(F.col("roadid").alias("road_id"))
    out = edges.join(met, "roadid", "left_semi").select(F.col("nextroadid").alias("road_id"))
    return R.merged_roads(direct=direct, chain=chain, intersection=into.unionByName(out).distinct())


def integrated(points: DataFrame, lanes: DataFrame) -> DataFrame:
    """Road and lane results of each trajectory side by side, with a status."""
    every = points.groupBy("dataset_name").agg(F.count("*").alias("total_points")).where("total_points >= 2")
    classes, at = R.lane_classes(lanes), points.select("dataset_name", "lon", "lat")
    touched = R.lane_counts(R.near_lanes(at, classes, 3.0)).select("dataset_name", F.col("lane_count").alias("total_roads"))
    kept = R.lane_rules(R.near_lanes(at, classes, 15.0)).select("dataset_name", F.col("lane_count").alias("total_lanes"), F.col("total_points").alias("hit_points"), "reason")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("total_roads", "total_lanes", "hit_points")]
    status = F.when(F.coalesce("total_roads", F.lit(0)) == 0, "no_roads").when(F.col("reason").isNull(), "no_lanes").otherwise("success")
    return every.join(touched, "dataset_name", "left").join(kept, "dataset_name", "left").select("dataset_name", "total_points", *zero, "reason", status.alias("status"))


def input_segments(points: DataFrame, metres: float = PIECE_METRES) -> DataFrame:
    """Pieces of each line that are closed once they are ``metres`` long (degrees over 111320), or at its end.

    ``(dataset_name, segment_id, start_index, end_index, length_meters, lon, lat, heading)``: ``lon, lat`` is the
    place half-way along; the next piece starts at the last one's end. Pieces under 10 m have no heading.
    """
    lines = points.where("lon is not null and lat is not null").groupBy("dataset_name").agg(F.array_sort(F.collect_list(F.struct("ts", "seq", "lon", "lat"))).alias("p"))
    p = lambda i: F.element_at("p", i + 1)
    step = lambda i: planar(p(i - 1)["lon"], p(i - 1)["lat"], p(i)["lon"], p(i)["lat"])
    last, limit = F.size("p") - 1, metres / METRES_PER_DEGREE
    none = F.array().cast("array<struct<start:int,stop:int,size:double>>")

    def walk(s: Column, i: Column) -> Column:
        total = s["total"] + step(i)
        closed = F.array(F.struct(s["start"].alias("start"), i.alias("stop"), total.alias("size")))
        cut = F.struct(F.lit(0.0).alias("total"), i.alias("start"), F.concat(s["cuts"], closed).alias("cuts"))
        return F.when((total >= limit) | (i == last), cut).otherwise(F.struct(total.alias("total"), s["start"].alias("start"), s["cuts"].alias("cuts")))

    begin = F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("start"), none.alias("cuts"))
    cuts = F.aggregate(F.sequence(F.lit(1), last), begin, walk)["cuts"]
    rows = lines.where(F.size("p") >= 2).select("dataset_name", "p", F.posexplode(cuts).alias("segment_id", "c"))
    rows = rows.select("dataset_name", "segment_id", F.slice("p", F.col("c.start") + 1, F.col("c.stop") - F.col("c.start") + 1).alias("p"), "c.start", "c.stop", "c.size")
    half, spot = F.col("size") / 2, lambda x, y, left: F.struct(x.alias("x"), y.alias("y"), left.alias("left"))

    def go(s: Column, i: Column) -> Column:
        t = s["left"] / F.nullif(step(i), F.lit(0.0))
        there = spot(p(i - 1)["lon"] + t * (p(i)["lon"] - p(i - 1)["lon"]), p(i - 1)["lat"] + t * (p(i)["lat"] - p(i - 1)["lat"]), F.lit(-1.0))
        return F.when(s["left"] < 0, s).when((step(i) > 0) & (s["left"] <= step(i)), there).otherwise(spot(p(i)["lon"], p(i)["lat"], s["left"] - step(i)))

    centre = F.aggregate(F.sequence(F.lit(1), F.size("p") - 1), spot(p(F.lit(0))["lon"], p(F.lit(0))["lat"], half), go)
    long_enough = F.col("size") * METRES_PER_DEGREE >= HEADING_METRES
    heading = F.when(long_enough, bearing(p(F.lit(0))["lon"], p(F.lit(0))["lat"], F.element_at("p", -1)["lon"], F.element_at("p", -1)["lat"]))
    return rows.select(
        "dataset_name", "segment_id", F.col("start").alias("start_index"), F.col("stop").alias("end_index"), (F.col("size") * METRES_PER_DEGREE).alias("length_meters"), centre["x"].alias("lon"), centre["y"].alias("lat"), heading.alias("heading")
    )


def candidate_lanes(segments: DataFrame, lanes: DataFrame, metres: float = 50.0, k: int = NEAR_LANES) -> DataFrame:
    """``(dataset_name, lane_id, segment_id, distance, heading_difference)``: lanes near the pieces' centres that lead the same way.

    The ``k`` nearest of each piece within ``metres``; those that lead another way by over 45 degrees go (where the
    piece has a heading); of a lane's pieces the nearest stays.
    """
    near = R.near_lanes(segments, lanes, metres, key=["dataset_name", "segment_id"], k=k)
    near = near.withColumn("heading_difference", F.when(F.col("heading").isNotNull(), heading_difference(F.col("heading"), R.lane_heading())))
    near = near.where(F.col("heading_difference").isNull() | (F.col("heading_difference") <= SAME_WAY))
    best = near.groupBy("dataset_name", "lane_id").agg(F.min(F.struct("distance", "segment_id", "heading_difference")).alias("b"))
    return best.select("dataset_name", "lane_id", "b.segment_id", "b.distance", "b.heading_difference")


def complete_trajectories(points: DataFrame, lanes: DataFrame, most: float = SAME_WAY) -> DataFrame:
    """Whole trajectories that the lane rules keep and that lead the way of a touched lane (within ``most`` degrees); those under 10 m needn't."""
    hits = R.near_lanes(points.select("dataset_name", "lon", "lat"), R.lane_classes(lanes), 15.0)
    kept = R.lane_rules(hits).withColumnsRenamed({"total_points": "hit_points", "lane_count": "total_lanes"})
    w = Window.partitionBy("dataset_name").orderBy("ts", "seq")
    stepped = points.join(shuffled(kept.select("dataset_name")), "dataset_name", "left_semi").withColumn("step", planar(F.lag("lon").over(w), F.lag("lat").over(w), F.col("lon"), F.col("lat")))
    ends = [f(c, F.struct("ts", "seq")).alias(n) for n, f, c in (("x1", F.min_by, "lon"), ("y1", F.min_by, "lat"), ("x2", F.max_by, "lon"), ("y2", F.max_by, "lat"))]
    v = F.col("twist_linear")
    whole = stepped.groupBy("dataset_name").agg(
        F.min("ts").alias("start_time"), F.max("ts").alias("end_time"), F.count("*").alias("total_points"), (F.coalesce(F.sum("step"), F.lit(0.0)) * METRES_PER_DEGREE).alias("length_meters"),
        F.coalesce(F.bround(F.avg(v), 2), F.lit(0.0)).alias("avg_speed"), F.coalesce(F.bround(F.max(v), 2), F.lit(0.0)).alias("max_speed"), F.coalesce(F.bround(F.min(v), 2), F.lit(0.0)).alias("min_speed"),
        F.coalesce(F.bround(F.avg((F.col("avp_flag") == 1).cast("double")), 3), F.lit(0.0)).alias("avp_ratio"), *ends,
    )
    heading = F.when(F.col("length_meters") >= HEADING_METRES, bearing(*[F.col(c) for c in ("x1", "y1", "x2", "y2")]))
    whole = whole.where("total_points >= 2").withColumn("trajectory_heading", heading).drop("x1", "y1", "x2", "y2").join(shuffled(kept), "dataset_name")
    ways = hits.select("dataset_name", R.lane_heading().alias("way")).distinct()
    same = ways.join(shuffled(whole.select("dataset_name", "trajectory_heading")), "dataset_name").where(heading_difference(F.col("way"), F.col("trajectory_heading")) <= most).select("dataset_name").distinct()
    fits = whole.join(shuffled(same.withColumn("same", F.lit(True))), "dataset_name", "left").where("trajectory_heading is null or same")
    return fits.drop("same")


def scene_mapping(rows: DataFrame, scenes: DataFrame | None = None) -> DataFrame:
    """Latest ``(scene_id, dataset_name, event_id, event_name)`` of each scene by ``updated_time``; event ids such as ``12.0`` become whole numbers."""
    if scenes is not None:
        rows = rows.join(scenes.select("scene_id"), "scene_id", "left_semi")
    latest = rows.groupBy("scene_id").agg(F.max_by(F.struct("dataset_name", "event_id", "event_name"), F.struct("updated_time", "event_id")).alias("m"))
    return latest.select("scene_id", "m.dataset_name", H.whole_number(F.col("m.event_id")).alias("event_id"), "m.event_name")


def segmented_records(points: DataFrame, records: DataFrame) -> DataFrame:
    """A row for each record whose dataset has two points or more: how many of its time ranges give a piece of two points, merged labels and the trajectory's statistics.

    ``segment_count`` is 0 where no range does; the whole trajectory then stands for the record, as it does for one without ranges.
    """
    ranges = H.ranges_of(records, "autoscene_id").select("dataset_name", F.struct("autoscene_id", "range_no").alias("range_no"), "lo", "hi")
    cut = H.cut_by_ranges(points, ranges).groupBy("range_no").agg(F.count("*").alias("points")).where("points >= 2")
    cut = cut.groupBy(F.col("range_no.autoscene_id").alias("autoscene_id")).agg(F.count("*").alias("segment_count"))
    span = F.max("ts") - F.min("ts")
    whole = points.groupBy("dataset_name").agg(F.min("ts").alias("start_time"), F.max("ts").alias("end_time"), F.count("*").alias("total_points"), (span / H.unit_of(span)).alias("total_duration")).where("total_points >= 2")
    labels = F.array_join(merged_labels(H.labels(F.col("result")), H.labels(F.col("other_scenario"))), ",")
    rows = records.join(whole, "dataset_name").join(cut, "autoscene_id", "left")
    return rows.select("autoscene_id", "dataset_name", F.coalesce("segment_count", F.lit(0)).alias("segment_count"), labels.alias("merged_results"), "total_points", "start_time", "end_time", "total_duration")


def record_lines(points: DataFrame, records: DataFrame) -> DataFrame:
    """``segmented_records`` with ``lines``: the pieces of two points or more that a record's time ranges cut, in the order of ranges, else the whole trajectory (``whole``), as lists of lines, and its speeds.

    ``avg_speed, max_speed, min_speed, avp_ratio`` are the whole trajectory's; records whose dataset has no two points
    have no row.
    """
    line = F.transform(F.array_sort(F.collect_list(F.struct("ts", "seq", "lon", "lat"))), lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat")))
    ranges = H.ranges_of(records, "autoscene_id").select("dataset_name", F.struct("autoscene_id", "range_no").alias("range_no"), "lo", "hi")
    cut = H.cut_by_ranges(points, ranges).groupBy("range_no").agg(line.alias("line")).where("size(line) >= 2")
    cut = cut.groupBy(F.col("range_no.autoscene_id").alias("autoscene_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("range_no.range_no", "line"))), lambda x: x["line"]).alias("cut"))
    whole = T.build(points).select("dataset_name", "avg_speed", "max_speed", "min_speed", "avp_ratio", "line")
    rows = segmented_records(points, records).join(whole, "dataset_name").join(cut, "autoscene_id", "left")
    return rows.withColumns({"whole": F.col("cut").isNull(), "lines": F.coalesce("cut", F.array("line"))}).drop("cut", "line")


def lane_statistics(points: DataFrame, lanes: DataFrame) -> DataFrame:
    """One row: totals and means of the lane analysis of all trajectories, and its filter efficiency in percent (rounded 2).

    Trajectories of two points or more are analysed; those that touch two lanes are multi-lane ones, others with
    enough points are kept for these.
    """
    every = points.groupBy("dataset_name").agg(F.count("*").alias("n")).where("n >= 2").select("dataset_name")
    candidates = candidate_lanes(input_segments(points), lanes).groupBy("dataset_name").agg(F.count("*").alias("candidate_lanes"))
    near = R.near_lanes(points.select("dataset_name", "seq", "lon", "lat"), R.lane_classes(lanes), 15.0)
    hits = near.groupBy("dataset_name").agg(F.countDistinct("seq").alias("hit_points"))
    kept = R.lane_rules(near).select("dataset_name", (F.col("lane_count") >= 2).alias("multi"))
    whole = complete_trajectories(points, lanes).select("dataset_name", F.lit(1).alias("complete"))
    rows = every.join(shuffled(candidates), "dataset_name", "left").join(shuffled(hits), "dataset_name", "left").join(shuffled(kept), "dataset_name", "left").join(shuffled(whole), "dataset_name", "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    n, multi, enough = F.count("*"), F.count_if("multi"), F.count_if(~F.col("multi"))
    mean = lambda c: F.round(total(c) / F.nullif(n, F.lit(0)), 2)
    return rows.agg(
        n.alias("input_trajectories_analyzed"), total("candidate_lanes").alias("total_candidate_lanes"), total("hit_points").alias("total_trajectory_points"), total("complete").alias("total_complete_trajectories"),
        multi.alias("total_multi_lane_trajectories"), enough.alias("total_sufficient_points_trajectories"), mean("candidate_lanes").alias("avg_candidate_lanes_per_input"), mean("hit_points").alias("avg_trajectory_points_per_input"),
        mean("complete").alias("avg_complete_trajectories_per_input"), F.round((multi + enough) * 100.0 / F.nullif(n, F.lit(0)), 2).alias("filter_efficiency_percentage"),
    )


def point_sources(points: DataFrame, areas: DataFrame) -> DataFrame:
    """``points`` with ``source_polygons``: the sources of all ``areas(polygon_id, source, envelope)`` that hold a point, joined by commas in the order of ids; else ``polygon_`` and the least id."""
    at = points.select("lon", "lat").distinct().select(F.col("lon").alias("xmin"), F.col("lat").alias("ymin"), F.col("lon").alias("xmax"), F.col("lat").alias("ymax"))  # places, each told once
    met = box_join(at, areas).groupBy(F.col("l_xmin").alias("lon"), F.col("l_ymin").alias("lat"))
    told = met.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r_polygon_id", "r_source"))), lambda x: x["r_source"]), ",").alias("told"))
    first = areas.agg(F.min("polygon_id").alias("first"))  # one row
    rows = points.join(told.hint("merge"), ["lon", "lat"], "left").crossJoin(F.broadcast(first))
    return rows.withColumn("source_polygons", F.coalesce("told", F.concat(F.lit("polygon_"), "first"))).drop("told", "first")


def result_rows(points: DataFrame, query_type: str = "text", areas: DataFrame | None = None) -> DataFrame:
    """Trajectory rows of found ``points``, with the sources of the first point, told by ``areas`` if given (``point_sources``); speeds only where there are any."""
    line = T.build(points)
    value = "source_polygons" if areas is None else F.struct("lon", "lat")
    first = points.groupBy("dataset_name").agg(F.min_by(value, F.struct("ts", "seq")).alias("source_polygons"))
    if areas is not None:
        first = point_sources(first.select("dataset_name", "source_polygons.*"), areas).select("dataset_name", "source_polygons")
    return line.join(first, "dataset_name").withColumn("query_type", F.lit(query_type))
