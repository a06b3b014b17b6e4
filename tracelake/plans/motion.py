"""Queries on trajectories, events, segments, features and clusters."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tracelake.functions.geo import METRES_PER_DEGREE_AREA, haversine, shoelace
from tracelake.operators import clustering as C
from tracelake.operators import datasets as D
from tracelake.operators import trajectories as T
from tracelake.operators.polygons import in_polygons
from tracelake.plans.registry import query

HAV = "2 * 6371000 * asin(sqrt((sin(radians({y2} - {y1}) / 2) ** 2 + cos(radians({y1})) * cos(radians({y2})) * sin(radians({x2} - {x1}) / 2) ** 2)))"
STEP = f"s AS (SELECT *, {HAV.format(x1='x', y1='y', x2='lon', y2='lat')} AS step, ts - t AS gap FROM (SELECT *, lag(lon) OVER w AS x, lag(lat) OVER w AS y, lag(ts) OVER w AS t FROM pts WINDOW w AS (PARTITION BY dataset_name ORDER BY ts, seq)))"
#: A walk over each trajectory: k numbers the points, start is the segment's first, piece counts cuts.
WALK = f"""{STEP}, o AS (SELECT *, row_number() OVER (PARTITION BY dataset_name ORDER BY ts, seq) AS k, count(*) OVER (PARTITION BY dataset_name) AS n FROM s), m AS (SELECT * FROM o WHERE n >= 5), w AS (
  SELECT dataset_name, k, ts AS start, CAST(0 AS DOUBLE) AS total, 0 AS piece FROM m WHERE k = 1
  UNION ALL SELECT m.dataset_name, m.k, CASE WHEN m.gap > 3 OR w.total + m.step >= 50 OR m.ts - w.start >= 15 THEN m.ts ELSE w.start END, CASE WHEN m.gap > 3 OR w.total + m.step >= 50 OR m.ts - w.start >= 15 THEN 0 ELSE w.total + m.step END,
    w.piece + CASE WHEN m.gap > 3 OR w.total + m.step >= 50 OR m.ts - w.start >= 15 THEN 1 ELSE 0 END FROM w JOIN m ON m.dataset_name = w.dataset_name AND m.k = w.k + 1
), g AS (SELECT dataset_name, piece, row_number() OVER (PARTITION BY dataset_name ORDER BY piece) - 1 AS segment_index FROM w GROUP BY 1, 2 HAVING count(*) >= 5),
p AS (SELECT m.*, CAST(g.segment_index AS INT) AS segment_index FROM w JOIN g USING (dataset_name, piece) JOIN m ON m.dataset_name = w.dataset_name AND m.k = w.k)"""
SEGS = WALK + """, q AS (SELECT *, CASE WHEN lag(lon) OVER v IS NULL THEN NULL ELSE step END AS st, (twist_linear - lag(twist_linear) OVER v) / greatest(ts - lag(ts) OVER v, 0.1) AS accel, abs(yaw - lag(yaw) OVER v) / greatest(ts - lag(ts) OVER v, 0.1) AS turn FROM p WINDOW v AS (PARTITION BY dataset_name, segment_index ORDER BY ts, seq)),
f AS (SELECT dataset_name, segment_index, min(ts) AS start_time, max(ts) AS end_time, count(*) AS point_count, coalesce(sum(st), 0) AS length, coalesce(max(st), 0) AS max_step, avg(twist_linear) AS avg_speed, stddev_pop(twist_linear) AS std_speed, max(twist_linear) AS max_speed, min(twist_linear) AS min_speed,
  avg(accel) AS avg_accel, stddev_pop(accel) AS std_accel, avg(turn) AS avg_yaw_rate, stddev_pop(yaw) AS std_yaw, arg_min(lon, seq) AS lon1, arg_min(lat, seq) AS lat1, arg_max(lon, seq) AS lon2, arg_max(lat, seq) AS lat2 FROM q GROUP BY 1, 2),
z AS (SELECT *, CASE WHEN max_step > 100 THEN 'gps_jump' WHEN avg_speed > 30 THEN 'excessive_speed' WHEN length < 10 THEN 'stationary' ELSE 'moving' END AS quality_flag FROM f)"""
KEY = ["dataset_name", "segment_index"]


def segs(pts):
    return T.segments(T.segmented(pts))


@query("d5_points_in_polygons", "pts", "crossings", sql="""
SELECT p.dataset_name, p.seq, c.intersection_id AS polygon_id FROM pts p JOIN crossings c ON c.intersectionsubtype = 3 AND p.lon >= c.xmin AND p.lat >= c.ymin AND p.lon - c.xmin + (p.lat - c.ymin) <= c.xmax - c.xmin + 0.000000000001""")
def d5(pts, crossings):
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ring = F.array(corner("xmin", "ymin"), corner("xmax", "ymin"), F.struct(F.col("xmin").alias("x"), (F.col("ymin") + F.col("xmax") - F.col("xmin")).alias("y")))
    triangles = crossings.where("intersectionsubtype = 3").select(F.col("intersection_id").alias("polygon_id"), F.array(ring).alias("rings"))
    return in_polygons(pts, triangles).select("dataset_name", "seq", "polygon_id")


@query("d6_trajectories", "pts", sql="""
SELECT dataset_name, min(ts) AS start_time, max(ts) AS end_time, max(ts) - min(ts) AS duration, count(*) AS point_count, round_even(avg(twist_linear), 2) AS avg_speed,
  round_even(coalesce(stddev_samp(twist_linear), 0), 2) AS std_speed, round_even(avg(CAST(avp_flag = 1 AS DOUBLE)), 3) AS avp_ratio, len(list(lon)) AS line_points FROM pts GROUP BY 1 HAVING count(*) >= 2""".replace("CAST(avp_flag = 1 AS DOUBLE)", "CASE WHEN avp_flag = 1 THEN 1.0::DOUBLE WHEN avp_flag IS NOT NULL THEN 0 END"))
def d6(pts):
    return T.build(pts).withColumn("line_points", F.size("line").cast("long")).drop("line", "max_speed", "min_speed")


@query("d11_speed_range", "pts", sql="SELECT dataset_name, max(twist_linear) AS max_speed, min(twist_linear) AS min_speed, count(*) AS point_count FROM pts GROUP BY 1")
def d11(pts):
    return pts.groupBy("dataset_name").agg(F.max("twist_linear").alias("max_speed"), F.min("twist_linear").alias("min_speed"), F.count("*").alias("point_count"))


@query("d7_latest_record", "events", sql="SELECT event_type, user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id) AS r FROM events) WHERE r = 1")
def d7(events):
    return D.latest(events, ["event_type", "user_id"], F.desc("ts"), F.asc("event_id")).select("event_type", "user_id", "event_id")


@query("d8_fallback_source", "orders", "customer", sql="SELECT c_custkey AS k, 'main' AS found FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) UNION ALL SELECT c_custkey, 'other' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def d8(orders, customer):
    main = orders.select(F.col("o_custkey").alias("k")).distinct().withColumn("found", F.lit("main"))
    other = customer.select(F.col("c_custkey").alias("k"), F.lit("other").alias("found"))
    return D.with_fallback(main, other, customer.select(F.col("c_custkey").alias("k")), "k")


@query("d9_avp_changes", "pts", sql="SELECT * FROM (SELECT dataset_name, seq, coalesce(avp_flag, 0) AS to_avp, lag(coalesce(avp_flag, 0)) OVER (PARTITION BY dataset_name ORDER BY ts, seq) AS from_avp FROM pts) WHERE from_avp <> to_avp")
def d9(pts):
    return T.avp_changes(pts).select("dataset_name", "seq", "to_avp", "from_avp")


SPIKES = "SELECT *, abs(twist_linear - m) / s AS z FROM (SELECT *, avg(twist_linear) OVER w AS m, stddev_samp(twist_linear) OVER w AS s, count(twist_linear) OVER w AS n FROM pts WINDOW w AS (PARTITION BY dataset_name)) WHERE n >= 3 AND s > 0"


@query("d10_speed_spikes", "pts", sql=f"SELECT dataset_name, seq, round(z, 6) AS z_score FROM ({SPIKES}) WHERE z > 2")
def d10(pts):
    return T.speed_spikes(pts).select("dataset_name", "seq", F.round("z_score", 6).alias("z_score"))


@query("d12_ordered_points", "pts", sql="SELECT seq, ts, lon, lat FROM pts WHERE dataset_name = 'traj_1' ORDER BY ts, seq")
def d12(pts):
    return pts.where("dataset_name = 'traj_1'").orderBy("ts", "seq").select("seq", "ts", "lon", "lat")


@query("d13_events", "pts", sql=f"""
SELECT dataset_name, seq, 'avp_change' AS event_type, CAST(from_avp AS DOUBLE) AS from_avp, CAST(to_avp AS DOUBLE) AS to_avp, CAST(NULL AS DOUBLE) AS speed FROM (SELECT dataset_name, seq, coalesce(avp_flag, 0) AS to_avp, lag(coalesce(avp_flag, 0)) OVER (PARTITION BY dataset_name ORDER BY ts, seq) AS from_avp FROM pts) WHERE from_avp <> to_avp
UNION ALL SELECT dataset_name, seq, 'speed_spike', NULL, NULL, twist_linear FROM ({SPIKES}) WHERE z > 2""")
def d13(pts):
    return T.events(pts).select("dataset_name", "seq", "event_type", F.col("from_avp").cast("double").alias("from_avp"), F.col("to_avp").cast("double").alias("to_avp"), "speed")


@query("d14_scene_counters", "pts", "scenes", sql="""
SELECT count(*) AS scenes, count(n) AS with_points, count(*) - count(n) AS missing, CAST(sum(n) AS BIGINT) AS points FROM scenes s LEFT JOIN (SELECT scene_token, count(*) AS n FROM pts GROUP BY 1) p ON p.scene_token = s.scene_id""")
def d14(pts, scenes):
    per = pts.groupBy(F.col("scene_token").alias("scene_id")).agg(F.count("*").alias("n"))
    return scenes.join(per, "scene_id", "left").agg(F.count("*").alias("scenes"), F.count("n").alias("with_points"), (F.count("*") - F.count("n")).alias("missing"), F.sum("n").alias("points"))


@query("d15_complete_trajectories", "pts", "crossings", sql="""
WITH x AS (SELECT p.dataset_name, arg_min(c.intersection_id, p.ts * 1000000 + c.intersection_id) AS polygon_id FROM pts p JOIN crossings c ON c.intersectiontype = 2 AND p.lon BETWEEN c.xmin AND c.xmax AND p.lat BETWEEN c.ymin AND c.ymax GROUP BY 1)
SELECT x.dataset_name, x.polygon_id, count(*) AS point_count FROM x JOIN pts USING (dataset_name) GROUP BY 1, 2""")
def d15(pts, crossings):
    from tracelake.plans.roads import stations

    first = stations(pts, crossings).groupBy("dataset_name").agg(F.min_by("polygon_id", F.struct("ts", "polygon_id")).alias("polygon_id"))
    return pts.join(first, "dataset_name").groupBy("dataset_name", "polygon_id").agg(F.count("*").alias("point_count"))


@query("f1_time_units", "pts", sql="SELECT dataset_name, seq, ts * CASE WHEN dataset_name LIKE '%1' THEN 1000 WHEN dataset_name LIKE '%2' THEN 1000000 ELSE 1 END AS raw, CAST(ts AS DOUBLE) AS seconds FROM pts")
def f1(pts):
    n = F.col("dataset_name")
    raw = F.col("ts") * F.when(n.endswith("1"), 1000).when(n.endswith("2"), 1000000).otherwise(1)
    return T.seconds(pts.withColumn("raw", raw), "raw").select("dataset_name", "seq", "raw", "seconds")


@query("f2_segmented_points", "pts", sql=f"WITH {WALK} SELECT dataset_name, seq, segment_index FROM p")
def f2(pts):
    return T.segmented(pts).select("dataset_name", "seq", "segment_index")


@query("f3_segments", "pts", sql=f"WITH {SEGS} SELECT dataset_name, segment_index, start_time, end_time, end_time - start_time AS duration, point_count FROM z")
def f3(pts):
    return segs(pts).select(*KEY, "start_time", "end_time", "duration", "point_count")


@query("f4_segment_quality", "pts", sql=f"WITH {SEGS} SELECT dataset_name, segment_index, quality_flag, round(length, 3) AS length, round(max_step, 3) AS max_step FROM z")
def f4(pts):
    return segs(pts).select(*KEY, "quality_flag", F.round("length", 3).alias("length"), F.round("max_step", 3).alias("max_step"))


COLUMNS = ", ".join(f"round({c}, 7) AS {c}" for c in T.FEATURES if not c.startswith("direction"))


@query("f5_segment_features", "pts", sql=f"WITH {SEGS} SELECT dataset_name, segment_index, {COLUMNS}, round(cos(atan2(lat2 - lat1, lon2 - lon1)), 7) AS direction_cos, round(sin(atan2(lat2 - lat1, lon2 - lon1)), 7) AS direction_sin FROM z")
def f5(pts):
    return segs(pts).select(*KEY, *[F.round(c, 7).alias(c) for c in T.FEATURES])


@query("f7_path_lengths", "pts", sql=f"WITH {STEP} SELECT dataset_name, round(sum(step), 3) AS length, round(max(step), 3) AS longest FROM s GROUP BY 1")
def f7(pts):
    return T.steps(pts).groupBy("dataset_name").agg(F.round(F.sum("step"), 3).alias("length"), F.round(F.max("step"), 3).alias("longest"))


@query("f10_behaviour", "pts", sql=f"""WITH {SEGS} SELECT dataset_name, count(*) AS segments, round(avg(avg_speed), 7) AS speed,
CASE WHEN avg(avg_speed) < 2 THEN '极低速(0-2m/s)' WHEN avg(avg_speed) < 5 THEN '低速(2-5m/s)' WHEN avg(avg_speed) < 10 THEN '中速(5-10m/s)' WHEN avg(avg_speed) < 15 THEN '较快(10-15m/s)' ELSE 'x' END AS speed_range,
CASE WHEN avg(avg_yaw_rate) > 0.3 THEN '转弯/变道' WHEN avg(avg_accel) < -1 THEN '减速/刹车' WHEN avg(avg_accel) > 1 THEN '加速' WHEN avg(avg_speed) < 3 THEN '缓慢移动' ELSE '直行通过' END AS behaviour FROM z GROUP BY 1""")
def f10(pts):
    # rounded twice: a mean that lies between two results must not hang on the order of addition
    return segs(pts).groupBy("dataset_name").agg(F.count("*").alias("segments"), F.round(F.round(F.avg("avg_speed"), 12), 7).alias("speed"), C.speed_range(F.avg("avg_speed")).alias("speed_range"), C.behaviour(F.lit(0), F.avg("avg_speed"), F.avg("avg_accel"), F.avg("avg_yaw_rate")).alias("behaviour"))


@query("f11_curvature", "pts", sql=f"WITH {SEGS} SELECT dataset_name, segment_index, round(length / greatest({HAV.format(x1='lon1', y1='lat1', x2='lon2', y2='lat2')}, 0.001), 3) AS curvature FROM z")
def f11(pts):
    return segs(pts).select(*KEY, F.round("curvature", 3).alias("curvature"))


@query("f16_top_groups", "pts", sql=f"WITH {SEGS}, c AS (SELECT quality_flag, dataset_name, count(*) AS n FROM z GROUP BY 1, 2) SELECT quality_flag, dataset_name, n FROM (SELECT *, row_number() OVER (PARTITION BY quality_flag ORDER BY n DESC, dataset_name) AS r FROM c) WHERE r <= 5")
def f16(pts):
    n = segs(pts).groupBy("quality_flag", "dataset_name").agg(F.count("*").alias("n"))
    return n.withColumn("r", F.row_number().over(Window.partitionBy("quality_flag").orderBy(F.desc("n"), "dataset_name"))).where("r <= 5").drop("r")


@query("f17_segments_with_summary", "pts", sql=f"WITH {SEGS}, c AS (SELECT dataset_name, count(*) AS segments FROM z WHERE quality_flag IN ('moving', 'stationary') GROUP BY 1) SELECT z.dataset_name, segment_index, segments FROM z LEFT JOIN c USING (dataset_name)")
def f17(pts):
    found = segs(pts)
    return found.join(T.valid(found).groupBy("dataset_name").agg(F.count("*").alias("segments")), "dataset_name", "left").select(*KEY, "segments")


@query("f18_quality_distribution", "pts", sql=f"WITH {SEGS} SELECT quality_flag, count(*) AS segments, CAST(sum(point_count) AS BIGINT) AS points, round(avg(avg_speed), 7) AS speed FROM z GROUP BY 1")
def f18(pts):
    return segs(pts).groupBy("quality_flag").agg(F.count("*").alias("segments"), F.sum("point_count").alias("points"), F.round(F.avg("avg_speed"), 7).alias("speed"))


@query("f19_point_features", "pts", sql=f"WITH {STEP} SELECT dataset_name, seq, round(step, 3) AS step, CAST(gap AS DOUBLE) AS gap, round(sum(step) OVER (PARTITION BY dataset_name ORDER BY ts, seq), 3) AS along FROM s")
def f19(pts):
    w = Window.partitionBy("dataset_name").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return T.steps(pts).select("dataset_name", "seq", F.round("step", 3).alias("step"), F.col("gap").cast("double").alias("gap"), F.round(F.sum("step").over(w), 3).alias("along"))


@query("f20_feature_points", "pts", sql="""
WITH a AS (SELECT *, abs(twist_linear - lag(twist_linear) OVER w) AS d FROM pts WINDOW w AS (PARTITION BY dataset_name ORDER BY ts, seq)), b AS (SELECT *, avg(d) OVER (PARTITION BY dataset_name) + 2 * stddev_pop(d) OVER (PARTITION BY dataset_name) AS lim FROM a)
SELECT dataset_name, seq, CASE WHEN d > lim THEN 'speed_change' ELSE 'stop' END AS kind FROM b WHERE d > lim OR twist_linear < 0.5""")
def f20(pts):
    w, all_ = Window.partitionBy("dataset_name").orderBy("ts", "seq"), Window.partitionBy("dataset_name")
    d = pts.withColumn("d", F.abs(F.col("twist_linear") - F.lag("twist_linear").over(w)))
    d = d.withColumn("limit", F.avg("d").over(all_) + 2 * F.stddev_pop("d").over(all_))
    return d.where("d > limit or twist_linear < 0.5").select("dataset_name", "seq", F.when(F.col("d") > F.col("limit"), "speed_change").otherwise("stop").alias("kind"))


@query("f33_tortuosity", "pts", sql=f"WITH {STEP}, e AS (SELECT dataset_name, sum(step) AS length, {HAV.format(x1='arg_min(lon, seq)', y1='arg_min(lat, seq)', x2='arg_max(lon, seq)', y2='arg_max(lat, seq)')} AS straight FROM s GROUP BY 1) SELECT dataset_name, round(CASE WHEN straight < 1 THEN 1 ELSE length / straight END, 4) AS tortuosity FROM e")
def f33(pts):
    ends = T.steps(pts).groupBy("dataset_name").agg(F.sum("step").alias("length"), *[f(c, "seq").alias(n) for n, f, c in (("a", F.min_by, "lon"), ("b", F.min_by, "lat"), ("c", F.max_by, "lon"), ("d", F.max_by, "lat"))])
    straight = haversine(*[F.col(c) for c in "abcd"])
    return ends.select("dataset_name", F.round(F.when(straight < 1, 1.0).otherwise(F.col("length") / straight), 4).alias("tortuosity"))


@query("f34_direction_entropy", "pts", sql="""
WITH a AS (SELECT dataset_name, atan2(lat - lag(lat) OVER w, lon - lag(lon) OVER w) AS h FROM pts WINDOW w AS (PARTITION BY dataset_name ORDER BY ts, seq)), b AS (SELECT dataset_name, least(floor((h + pi()) / (pi() / 4)), 7) AS bin, count(*) AS n FROM a WHERE h IS NOT NULL GROUP BY 1, 2),
c AS (SELECT dataset_name, n / CAST(sum(n) OVER (PARTITION BY dataset_name) AS DOUBLE) AS p FROM b) SELECT dataset_name, round(abs(sum(-p * log2(p))), 4) AS direction_entropy FROM c GROUP BY 1""")
def f34(pts):
    return T.direction_entropy(pts, "dataset_name").withColumn("direction_entropy", F.round("direction_entropy", 4))


@query("f35_speed_entropy", "pts", sql="""
WITH a AS (SELECT dataset_name, twist_linear AS v, min(twist_linear) OVER w AS lo, max(twist_linear) OVER w AS hi FROM pts WINDOW w AS (PARTITION BY dataset_name)), b AS (SELECT dataset_name, CASE WHEN hi > lo THEN least(floor((v - lo) / ((hi - lo) / 10)), 9) ELSE 0 END AS bin, count(*) AS n FROM a WHERE v IS NOT NULL GROUP BY 1, 2),
c AS (SELECT dataset_name, n / CAST(sum(n) OVER (PARTITION BY dataset_name) AS DOUBLE) AS p FROM b) SELECT dataset_name, round(abs(sum(-p * log2(p))), 4) AS value_entropy FROM c GROUP BY 1""")
def f35(pts):
    return T.value_entropy(pts, "twist_linear", "dataset_name").withColumn("value_entropy", F.round("value_entropy", 4))


@query("f36_stop_ratio", "pts", sql="SELECT dataset_name, round(avg(CASE WHEN twist_linear < 1 THEN 1.0::DOUBLE ELSE 0 END), 4) AS stop_ratio FROM pts GROUP BY 1")
def f36(pts):
    return pts.groupBy("dataset_name").agg(F.round(F.avg(F.when(F.col("twist_linear") < 1, 1.0).otherwise(0.0)), 4).alias("stop_ratio"))


@query("f37_speed_peaks", "pts", sql="""
SELECT dataset_name, count(*) FILTER (abs(v) > 2 AND ((v > a AND v > b) OR (v < a AND v < b))) AS peaks FROM (SELECT dataset_name, twist_linear AS v, lag(twist_linear) OVER w AS a, lead(twist_linear) OVER w AS b FROM pts WINDOW w AS (PARTITION BY dataset_name ORDER BY ts, seq)) GROUP BY 1""")
def f37(pts):
    return T.peaks(pts, "twist_linear", 2.0, "dataset_name")


@query("f38_envelope_area", "boxes", sql="SELECT scene_token, round((xmax - xmin) * (ymax - ymin) * 111000.0::DOUBLE * 111000, 0) AS area FROM boxes")
def f38(boxes):
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ring = F.array(corner("xmin", "ymin"), corner("xmax", "ymin"), corner("xmax", "ymax"), corner("xmin", "ymax"))
    return boxes.select("scene_token", F.round(shoelace(ring) * METRES_PER_DEGREE_AREA * METRES_PER_DEGREE_AREA, 0).alias("area"))


@query("f40_point_statistics", "pts", sql=f"WITH {STEP} SELECT city_id, count(*) AS points, count(DISTINCT dataset_name) AS datasets, round(avg(twist_linear), 4) AS speed, round(max(step), 3) AS longest FROM s GROUP BY 1")
def f40(pts):
    return T.steps(pts).groupBy("city_id").agg(F.count("*").alias("points"), F.countDistinct("dataset_name").alias("datasets"), F.round(F.avg("twist_linear"), 4).alias("speed"), F.round(F.max("step"), 3).alias("longest"))


@query("i6_merged_boxes", "boxes")
def i6(boxes):
    return C.merge_overlapping(boxes, "city_id", "scene_token", 0.7)


@query("e19_hulls", "pts")
def e19(pts):
    return C.convex_hull(pts, "city_id")
