"""Queries on roads, lanes and tolls."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelake.functions.geo import METRES_PER_DEGREE, bearing, haversine, heading_difference
from tracelake.operators import boxes as B
from tracelake.operators import roads as R
from tracelake.operators import trajectories as T
from tracelake.operators.polygons import in_polygons, rectangles
from tracelake.plans.registry import query

CHAIN = """c AS (
  SELECT {b} AS road_id, 0 AS depth, CAST(0 AS DOUBLE) AS distance, coalesce(length, 0) AS length FROM edges WHERE {a} IN (SELECT roadid FROM edges WHERE length <= 5)
  UNION SELECT e.{b}, c.depth + 1, c.distance + c.length, coalesce(e.length, 0) FROM c JOIN edges e ON e.{a} = c.road_id WHERE c.distance + c.length <= {limit} AND c.depth < 10
)"""
FORWARD, BACKWARD = CHAIN.format(a="roadid", b="nextroadid", limit=500), CHAIN.format(a="nextroadid", b="roadid", limit=100)
DIST = """sqrt((p.lon - (l.xmin + t * (l.xmax - l.xmin))) ** 2 + (p.lat - (l.ymin + t * (l.ymax - l.ymin))) ** 2)"""
NEAR = """n AS (SELECT p.*, l.intersection_id AS lane_id, l.intersectiontype, greatest(0, least(1, ((p.lon - l.xmin) * (l.xmax - l.xmin) + (p.lat - l.ymin) * (l.ymax - l.ymin)) / ((l.xmax - l.xmin) ** 2 + (l.ymax - l.ymin) ** 2))) AS t,
  l.xmin, l.ymin, l.xmax, l.ymax FROM pts p JOIN crossings l ON p.lon BETWEEN l.xmin - {r} AND l.xmax + {r} AND p.lat BETWEEN l.ymin - {r} AND l.ymax + {r}), h AS (
  SELECT * FROM (SELECT *, sqrt((lon - (xmin + t * (xmax - xmin))) ** 2 + (lat - (ymin + t * (ymax - ymin))) ** 2) AS distance FROM n) WHERE distance <= {r}::DOUBLE
)"""


def radius(metres):
    return repr(metres / METRES_PER_DEGREE)


def lanes_of(crossings):
    return crossings.withColumnRenamed("intersection_id", "lane_id")


@query("g1_lines_with_geometry", "pts", sql="SELECT dataset_name, count(*) AS point_count FROM pts WHERE lon IS NOT NULL AND lat IS NOT NULL GROUP BY 1 HAVING count(*) >= 2")
def g1(pts):
    return T.build(pts.where("lon is not null and lat is not null")).select("dataset_name", "point_count")


@query("g2_roads_near_trajectories", "pts", "crossings", sql=f"WITH {NEAR.format(r=radius(3))} SELECT DISTINCT dataset_name, lane_id FROM h")
def g2(pts, crossings):
    lanes = lanes_of(crossings)
    return R.named(R.touched_lanes(pts, lanes, 3), lanes, "lane_id")


@query("g5_forward_chains", "edges", sql=f"WITH {FORWARD} SELECT DISTINCT road_id, depth, distance FROM c")
def g5(edges):
    return R.chains(edges, edges.where("length <= 5").select("roadid"), 500.0)


@query("g6_backward_chains", "edges", sql=f"WITH {BACKWARD} SELECT DISTINCT road_id, depth, distance FROM c")
def g6(edges):
    return R.chains(edges, edges.where("length <= 5").select("roadid"), 100.0, backward=True)


@query("g7_chain_union", "edges", sql=f"""WITH {FORWARD}, {BACKWARD.replace('c AS', 'd AS', 1).replace('FROM c JOIN', 'FROM d JOIN').replace('c.', 'd.')},
u AS (SELECT * FROM c UNION ALL SELECT * FROM d) SELECT road_id, depth, distance FROM (SELECT *, row_number() OVER (PARTITION BY road_id ORDER BY depth, distance) AS r FROM u) WHERE r = 1""")
def g7(edges):
    ahead = R.chains(edges, edges.where("length <= 5").select("roadid"), 500.0)
    behind = R.chains(edges, edges.where("length <= 5").select("roadid"), 100.0, backward=True)
    return R.nearest_rows(ahead.unionByName(behind))


@query("g8_roads_of_crossings", "edges", "crossings", sql="""
SELECT roadid AS road_id FROM edges WHERE roadid IN (SELECT intersection_id FROM crossings WHERE intersectiontype = 2) UNION SELECT nextroadid FROM edges WHERE roadid IN (SELECT intersection_id FROM crossings WHERE intersectiontype = 3)""")
def g8(edges, crossings):
    some = lambda k: crossings.where(F.col("intersectiontype") == k).select(F.col("intersection_id").alias("roadid"))
    into = edges.join(some(2), "roadid", "left_semi").select(F.col("roadid").alias("road_id"))
    out = edges.join(some(3), "roadid", "left_semi").select(F.col("nextroadid").alias("road_id"))
    return into.union(out).distinct()


@query("g9_lanes_of_roads", "edges", "crossings", sql="SELECT intersection_id AS lane_id, intersectiontype FROM crossings WHERE intersection_id IN (SELECT nextroadid FROM edges WHERE length > 150)")
def g9(edges, crossings):
    roads = edges.where("length > 150").select(F.col("nextroadid").alias("lane_id"))
    return lanes_of(crossings).join(roads, "lane_id", "left_semi").select("lane_id", "intersectiontype")


@query("g11_lanes_per_road", "edges", sql="SELECT nextroadid AS road_id, count(*) AS lane_count, round(sum(length), 3) AS length FROM edges GROUP BY 1")
def g11(edges):
    return edges.groupBy(F.col("nextroadid").alias("road_id")).agg(F.count("*").alias("lane_count"), F.round(F.sum("length"), 3).alias("length"))


@query("g13_link_flags", "lineitem", "orders", sql="""
SELECT l_orderkey AS id, l_linenumber AS patchid, l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AS has_in, (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_returnflag = 'R') AS has_out
FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""")
def g13(lineitem, orders):
    keys = ["id", "patchid"]
    roads = lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("patchid"))
    into = roads.join(orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id")), "id", "left_semi")
    out = lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("patchid"))
    return R.link_flags(roads.distinct(), keys, has_in=into, has_out=out)


CLIP = """WITH p AS (SELECT b.scene_token, l.intersection_id AS lane_id, l.xmin AS x1, l.ymin AS y1, l.xmax - l.xmin AS dx, l.ymax - l.ymin AS dy, b.* EXCLUDE (scene_token) FROM crossings l JOIN boxes b ON b.xmin <= l.xmax AND b.xmax >= l.xmin AND b.ymin <= l.ymax AND b.ymax >= l.ymin),
s AS (SELECT *, greatest(0, (xmin - x1) / dx, (ymin - y1) / dy) AS a, least(1, (xmax - x1) / dx, (ymax - y1) / dy) AS z FROM p)
SELECT scene_token, lane_id, CASE WHEN x1 >= xmin AND x1 + dx <= xmax AND y1 >= ymin AND y1 + dy <= ymax THEN 'WITHIN' ELSE 'INTERSECTS' END AS relation, round(sqrt(dx * dx + dy * dy) * 111320, 3) AS metres, round(greatest(0, z - a), 5) AS share FROM s WHERE z - a > 0.001"""


@query("g15_lanes_in_boxes", "boxes", "crossings", sql=CLIP)
def g15(boxes, crossings):
    met = B.box_join(B.folded(crossings.select(*B.BOX, F.col("intersection_id").alias("lane_id"))), B.folded(boxes.select(*B.BOX, "scene_token")))
    met = met.select("l_members", "r_members", *[F.col(f"l_{c}").alias(c) for c in ("xmin", "ymin", "xmax", "ymax")], *[F.col(f"r_{c}").alias(f"b_{c}") for c in ("xmin", "ymin", "xmax", "ymax")])
    inside = (F.col("xmin") >= F.col("b_xmin")) & (F.col("xmax") <= F.col("b_xmax")) & (F.col("ymin") >= F.col("b_ymin")) & (F.col("ymax") <= F.col("b_ymax"))
    dx, dy = F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")
    out = met.withColumn("part", R.line_in_box()).where("part > 0.001")
    out = out.select("l_members", "r_members", F.when(inside, "WITHIN").otherwise("INTERSECTS").alias("relation"), F.round(F.sqrt(dx * dx + dy * dy) * METRES_PER_DEGREE, 3).alias("metres"), F.round("part", 5).alias("share"))
    return B.unfolded(out, "l_", "r_").select(F.col("r_scene_token").alias("scene_token"), F.col("l_lane_id").alias("lane_id"), "relation", "metres", "share")


@query("g16_nearest_lanes", "pts", "crossings", sql=f"WITH {NEAR.format(r=radius(50))} SELECT dataset_name, seq, lane_id, nth FROM (SELECT *, CAST(row_number() OVER (PARTITION BY dataset_name, seq ORDER BY distance, lane_id) AS INT) AS nth FROM h) WHERE nth <= 10")
def g16(pts, crossings):
    slim = pts.select("dataset_name", "seq", "lon", "lat"), lanes_of(crossings).select("lane_id", "xmin", "ymin", "xmax", "ymax")
    return R.near_lanes(*slim, 50, key=["dataset_name", "seq"], k=10).select("dataset_name", "seq", "lane_id", "nth")


HEADING = "(degrees(atan2(sin(radians(x2 - x1)) * cos(radians(y2)), cos(radians(y1)) * sin(radians(y2)) - sin(radians(y1)) * cos(radians(y2)) * cos(radians(x2 - x1)))) + 360) % 360"


@query("g18_headings", "crossings", sql=f"WITH x AS (SELECT intersection_id, xmin AS x1, ymin AS y1, xmax AS x2, ymax AS y2 FROM crossings) SELECT intersection_id, round({HEADING}, 3) AS heading FROM x")
def g18(crossings):
    return crossings.select("intersection_id", F.round(R.lane_heading(), 3).alias("heading"))


@query("g19_mean_headings", "pts", sql=f"""
WITH x AS (SELECT dataset_name, lon AS x2, lat AS y2, lag(lon) OVER w AS x1, lag(lat) OVER w AS y1 FROM pts WINDOW w AS (PARTITION BY dataset_name ORDER BY ts, seq)),
y AS (SELECT dataset_name, {HEADING} AS h, 2 * 6371000 * asin(sqrt(sin(radians(y2 - y1) / 2) ** 2 + cos(radians(y1)) * cos(radians(y2)) * sin(radians(x2 - x1) / 2) ** 2)) AS w FROM x WHERE x1 IS NOT NULL)
SELECT dataset_name, round((degrees(atan2(sum(sin(radians(h)) * w), sum(cos(radians(h)) * w))) + 360) % 360, 3) AS heading FROM y GROUP BY 1""")
def g19(pts):
    from pyspark.sql import Window

    w = Window.partitionBy("dataset_name").orderBy("ts", "seq")
    ends = pts.withColumns({"x": F.lag("lon").over(w), "y": F.lag("lat").over(w)}).where("x is not null")
    h, d = F.radians(bearing(F.col("x"), F.col("y"), F.col("lon"), F.col("lat"))), haversine(F.col("x"), F.col("y"), F.col("lon"), F.col("lat"))
    return ends.groupBy("dataset_name").agg(F.round(F.pmod(F.degrees(F.atan2(F.sum(F.sin(h) * d), F.sum(F.cos(h) * d))) + 360, F.lit(360.0)), 3).alias("heading"))


@query("g20_same_direction", "pts", "crossings", sql=f"""WITH {NEAR.format(r=radius(15))}, x AS (SELECT dataset_name, seq, lane_id, degrees(yaw) AS d, xmin AS x1, ymin AS y1, xmax AS x2, ymax AS y2 FROM h), y AS (SELECT dataset_name, seq, lane_id, abs(d % 360 - {HEADING}) AS g FROM x)
SELECT dataset_name, seq, lane_id, least(g, 360 - g) <= 45 AS same FROM y""")
def g20(pts, crossings):
    near = R.near_lanes(pts.select("dataset_name", "seq", "lon", "lat", "yaw"), lanes_of(crossings).select("lane_id", *B.BOX), 15)
    return near.select("dataset_name", "seq", "lane_id", R.same_direction(F.degrees("yaw") % 360, R.lane_heading()).alias("same"))


@query("g21_lane_rules", "pts", "crossings", sql=f"""WITH {NEAR.format(r=radius(15))}, a AS (SELECT dataset_name, count(*) AS total_points, count(DISTINCT lane_id) AS lane_count FROM h GROUP BY 1)
SELECT *, CASE WHEN lane_count >= 2 THEN concat('multi_lane_', lane_count, '_lanes') ELSE concat('sufficient_points_', total_points, '_points') END AS reason FROM a WHERE lane_count >= 2 OR total_points >= 5""")
def g21(pts, crossings):
    return R.lane_rules(R.near_lanes(pts.select("dataset_name", "lon", "lat"), R.lane_classes(lanes_of(crossings)), 15))


@query("g23_toll_stations", "crossings", sql="SELECT intersection_id, xmin, ymin FROM crossings WHERE intersectiontype = 2")
def g23(crossings):
    return crossings.where("intersectiontype = 2").select("intersection_id", "xmin", "ymin")


TOLL = "pts p JOIN crossings c ON c.intersectiontype = 2 AND p.lon BETWEEN c.xmin AND c.xmax AND p.lat BETWEEN c.ymin AND c.ymax"


def stations(pts, crossings):
    return in_polygons(pts, rectangles(crossings.where("intersectiontype = 2"), "intersection_id"))


@query("g24_trajectories_in_tolls", "pts", "crossings", sql=f"SELECT c.intersection_id AS polygon_id, p.dataset_name, count(*) AS point_count, min(p.ts) AS first_ts, round(avg(CASE WHEN p.workstage = 2 THEN 1.0::DOUBLE ELSE 0 END), 4) AS workstage_2_ratio FROM {TOLL} GROUP BY 1, 2")
def g24(pts, crossings):
    return stations(pts, crossings).groupBy("polygon_id", "dataset_name").agg(F.count("*").alias("point_count"), F.min("ts").alias("first_ts"), F.round(F.avg(F.when(F.col("workstage") == 2, 1.0).otherwise(0.0)), 4).alias("workstage_2_ratio"))


@query("g25_toll_summary", "pts", "crossings", sql=f"SELECT count(DISTINCT c.intersection_id) AS stations, count(DISTINCT p.dataset_name) AS datasets, count(*) AS points FROM {TOLL}")
def g25(pts, crossings):
    return stations(pts, crossings).agg(F.countDistinct("polygon_id").alias("stations"), F.countDistinct("dataset_name").alias("datasets"), F.count("*").alias("points"))


@query("g26_newest_lane_points", "pts", "crossings", sql=f"""WITH {NEAR.format(r=radius(15))}, k AS (SELECT *, row_number() OVER (PARTITION BY lane_id ORDER BY ts DESC, dataset_name, seq) AS r FROM h WHERE ts >= 1704067260)
SELECT dataset_name, count(*) AS total_points, count(DISTINCT lane_id) AS lanes FROM k WHERE r <= 1000 GROUP BY 1""")
def g26(pts, crossings):
    from pyspark.sql import Window

    near = R.near_lanes(pts.where("ts >= 1704067260").select("dataset_name", "ts", "seq", "lon", "lat"), R.lane_classes(lanes_of(crossings)), 15)
    newest = Window.partitionBy("lane_id").orderBy(F.desc("ts"), "dataset_name", "seq")
    return near.withColumn("r", F.row_number().over(newest)).where("r <= 1000").transform(R.lane_counts).withColumnRenamed("lane_count", "lanes")


@query("g27_complete_with_heading", "pts", "crossings", sql=f"""WITH {NEAR.format(r=radius(15))}, o AS (SELECT dataset_name, arg_min(lon, seq) AS x1, arg_min(lat, seq) AS y1, arg_max(lon, seq) AS x2, arg_max(lat, seq) AS y2, count(*) AS point_count, round(avg(twist_linear), 4) AS avg_speed FROM pts GROUP BY 1),
q AS (SELECT o.*, {HEADING} AS hd FROM o), l AS (SELECT DISTINCT dataset_name, lane_id, xmin AS x1, ymin AS y1, xmax AS x2, ymax AS y2 FROM h), m AS (SELECT dataset_name, lane_id, {HEADING} AS hl FROM l)
SELECT dataset_name, point_count, avg_speed FROM q WHERE EXISTS (SELECT 1 FROM m WHERE m.dataset_name = q.dataset_name AND least(abs(hl - hd), 360 - abs(hl - hd)) <= 60)""")
def g27(pts, crossings):
    ends = pts.groupBy("dataset_name").agg(*[f(c, "seq").alias(n) for n, f, c in (("x1", F.min_by, "lon"), ("y1", F.min_by, "lat"), ("x2", F.max_by, "lon"), ("y2", F.max_by, "lat"))], F.count("*").alias("point_count"), F.round(F.avg("twist_linear"), 4).alias("avg_speed"))
    whole = ends.withColumn("heading", bearing(*[F.col(c) for c in ("x1", "y1", "x2", "y2")]))
    touched = R.touched_lanes(pts, crossings, 15).select("dataset_name", R.lane_heading().alias("lane_heading"))
    fit = touched.join(whole, "dataset_name").where(heading_difference(F.col("lane_heading"), F.col("heading")) <= 60).select("dataset_name").distinct()
    return whole.join(fit, "dataset_name", "left_semi").select("dataset_name", "point_count", "avg_speed")


@query("g30_roads_per_polygon", "boxes", "crossings", sql="SELECT b.scene_token AS polygon_id, count(*) AS roads FROM boxes b JOIN crossings c ON b.xmin <= c.xmax AND b.xmax >= c.xmin AND b.ymin <= c.ymax AND b.ymax >= c.ymin WHERE c.intersectiontype = 4 GROUP BY 1")
def g30(boxes, crossings):
    return B.hit_counts(boxes, crossings.where("intersectiontype = 4"), "scene_token").where("hits > 0").select(F.col("scene_token").alias("polygon_id"), F.col("hits").alias("roads"))


@query("g31_integrated_stats", "pts", "crossings", sql=f"""WITH {NEAR.format(r=radius(15))}, a AS (SELECT dataset_name, count(DISTINCT lane_id) AS lanes FROM h GROUP BY 1), t AS (SELECT count(DISTINCT dataset_name) AS n FROM pts)
SELECT n AS trajectories, (SELECT count(*) FROM a) AS matched, round((SELECT count(*) FROM a) * 100.0::DOUBLE / n, 2) AS success_rate, CAST((SELECT sum(lanes) FROM a) AS BIGINT) AS total_lanes, round((SELECT sum(lanes) FROM a) / n::DOUBLE, 2) AS mean_lanes FROM t""")
def g31(pts, crossings):
    hits = R.near_lanes(pts.select("dataset_name", "lon", "lat"), R.lane_classes(lanes_of(crossings)), 15)
    per = R.lane_counts(hits).withColumnRenamed("lane_count", "lanes")
    every = pts.select("dataset_name").distinct().join(per, "dataset_name", "left")
    n = F.count("*")
    return every.agg(n.alias("trajectories"), F.count("lanes").alias("matched"), F.round(F.count("lanes") * 100.0 / n, 2).alias("success_rate"), F.sum("lanes").alias("total_lanes"), F.round(F.sum("lanes") / n, 2).alias("mean_lanes"))


@query("g38_most_lanes", "edges", sql="SELECT nextroadid % 50 AS analysis, count(*) AS lanes FROM edges GROUP BY 1 ORDER BY lanes DESC, analysis LIMIT 5")
def g38(edges):
    return edges.groupBy((F.col("nextroadid") % 50).alias("analysis")).agg(F.count("*").alias("lanes")).orderBy(F.desc("lanes"), "analysis").limit(5)


@query("g39_result_names", "scenes", sql="SELECT scene_id, substr(concat('lane_', CASE WHEN length(subdataset_name) > 4 THEN substr(md5(scene_id), 1, 8) ELSE right(scene_id, 8) END), 1, 63) AS table_name FROM scenes")
def g39(scenes):
    end = F.when(F.length("subdataset_name") > 4, F.substring(F.md5(F.col("scene_id").cast("binary")), 1, 8)).otherwise(F.right("scene_id", F.lit(8)))
    return scenes.select("scene_id", F.substring(F.concat(F.lit("lane_"), end), 1, 63).alias("table_name"))
