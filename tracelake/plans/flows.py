"""Queries on whole workflows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelake.functions.geo import METRES_PER_DEGREE
from tracelake.operators import datasets as D
from tracelake.operators import density as E
from tracelake.operators import quality_check as H
from tracelake.operators import roads as R
from tracelake.operators import workflows as W
from tracelake.operators.polygons import rectangles
from tracelake.plans.media import CLEAN, RECORDS, records
from tracelake.plans.places import ALL
from tracelake.plans.registry import query
from tracelake.plans.roads import HEADING, NEAR, TOLL, lanes_of, radius

TURN = "least(abs({a} - {b}), 360 - abs({a} - {b}))"


@query("d19_polygons_to_trajectories", "pts", "crossings", sql=f"""WITH g AS (SELECT dataset_name, string_agg(CAST(intersection_id AS VARCHAR), ',' ORDER BY intersection_id) AS polygon_ids FROM (SELECT DISTINCT p.dataset_name, c.intersection_id FROM {TOLL}) GROUP BY 1)
SELECT dataset_name, polygon_ids, count(*) AS point_count, min(ts) AS start_time, max(ts) AS end_time, max(ts) - min(ts) AS duration FROM pts JOIN g USING (dataset_name) GROUP BY 1, 2 HAVING count(*) >= 2""")
def d19(pts, crossings):
    found = W.polygon_trajectories(pts, rectangles(crossings.where("intersectiontype = 2"), "intersection_id"))
    ids = F.array_join(F.transform("polygon_ids", lambda i: i.cast("string")), ",")
    return found.select("dataset_name", ids.alias("polygon_ids"), "point_count", "start_time", "end_time", "duration")


GO = """{n} AS (SELECT {b} AS road_id, 0 AS depth, CAST(0 AS DOUBLE) AS distance, coalesce(length, 0) AS length FROM edges WHERE {a} IN (SELECT road_id FROM di)
  UNION SELECT e.{b}, {n}.depth + 1, {n}.distance + {n}.length, coalesce(e.length, 0) FROM {n} JOIN edges e ON e.{a} = {n}.road_id WHERE {n}.distance + {n}.length <= {limit} AND {n}.depth < 10)"""


@query("g10_all_roads", "pts", "crossings", "edges", sql=f"""WITH {NEAR.format(r=radius(3))}, di AS (SELECT DISTINCT lane_id AS road_id FROM h), {GO.format(n='fo', a='roadid', b='nextroadid', limit=500)}, {GO.format(n='ba', a='nextroadid', b='roadid', limit=100)},
me AS (SELECT DISTINCT c.intersection_id FROM pts p JOIN crossings c ON greatest(0, c.xmin - p.lon, p.lon - c.xmax) ** 2 + greatest(0, c.ymin - p.lat, p.lat - c.ymax) ** 2 <= {radius(3)}::DOUBLE * {radius(3)}::DOUBLE),
u AS (SELECT road_id, 0 AS n, 'direct' AS kind FROM di UNION ALL SELECT road_id, 1, 'chain' FROM fo UNION ALL SELECT road_id, 1, 'chain' FROM ba UNION ALL SELECT roadid, 2, 'intersection' FROM edges WHERE roadid IN (SELECT * FROM me) UNION ALL SELECT nextroadid, 2, 'intersection' FROM edges WHERE roadid IN (SELECT * FROM me))
SELECT road_id, arg_min(kind, n) AS kind FROM u GROUP BY 1""")
def g10(pts, crossings, edges):
    return W.all_roads(pts, lanes_of(crossings), edges, crossings)


@query("g42_integrated_results", "pts", "crossings", sql=f"""WITH {NEAR.format(r=radius(15))}, a AS (SELECT dataset_name, count(*) AS hit_points, count(DISTINCT lane_id) AS total_lanes FROM h GROUP BY 1), k AS (SELECT *, CASE WHEN total_lanes >= 2 THEN concat('multi_lane_', total_lanes, '_lanes') ELSE concat('sufficient_points_', hit_points, '_points') END AS reason FROM a WHERE total_lanes >= 2 OR hit_points >= 5),
n3 AS (SELECT dataset_name, count(DISTINCT lane_id) AS total_roads FROM h WHERE distance <= {radius(3)}::DOUBLE GROUP BY 1), e AS (SELECT dataset_name, count(*) AS total_points FROM pts GROUP BY 1 HAVING count(*) >= 2)
SELECT e.dataset_name, total_points, coalesce(total_roads, 0) AS total_roads, coalesce(total_lanes, 0) AS total_lanes, coalesce(hit_points, 0) AS hit_points, reason, CASE WHEN coalesce(total_roads, 0) = 0 THEN 'no_roads' WHEN reason IS NULL THEN 'no_lanes' ELSE 'success' END AS status FROM e LEFT JOIN n3 USING (dataset_name) LEFT JOIN k USING (dataset_name)""")
def g42(pts, crossings):
    return W.integrated(pts, lanes_of(crossings))


PIECES = f"""ks AS (SELECT dataset_name, lon, lat, row_number() OVER w - 1 AS k, count(*) OVER (PARTITION BY dataset_name) AS n, sqrt((lon - lag(lon) OVER w) * (lon - lag(lon) OVER w) + (lat - lag(lat) OVER w) * (lat - lag(lat) OVER w)) AS step FROM pts WINDOW w AS (PARTITION BY dataset_name ORDER BY ts, seq)),
wk AS (SELECT dataset_name, k, CAST(0 AS DOUBLE) AS total, CAST(0 AS DOUBLE) AS acc FROM ks WHERE k = 0 AND n >= 2 UNION ALL SELECT ks.dataset_name, ks.k, CASE WHEN wk.total + ks.step >= {radius(50)}::DOUBLE THEN 0 ELSE wk.total + ks.step END, wk.total + ks.step FROM wk JOIN ks ON ks.dataset_name = wk.dataset_name AND ks.k = wk.k + 1),
en AS (SELECT dataset_name, k AS end_index, acc AS size, coalesce(lag(k) OVER (PARTITION BY dataset_name ORDER BY k), 0) AS start_index, row_number() OVER (PARTITION BY dataset_name ORDER BY k) - 1 AS segment_id FROM wk JOIN (SELECT dataset_name AS dn, max(n) AS n FROM ks GROUP BY 1) ON dn = dataset_name WHERE k > 0 AND (acc >= {radius(50)}::DOUBLE OR k = n - 1)),
cu AS (SELECT en.dataset_name, segment_id, start_index, end_index, size, ks.k, ks.lon, ks.lat, CASE WHEN ks.k = start_index THEN 0 ELSE ks.step END AS step, sum(CASE WHEN ks.k = start_index THEN 0 ELSE ks.step END) OVER (PARTITION BY en.dataset_name, segment_id ORDER BY ks.k) AS along, lag(ks.lon) OVER (PARTITION BY en.dataset_name, segment_id ORDER BY ks.k) AS px, lag(ks.lat) OVER (PARTITION BY en.dataset_name, segment_id ORDER BY ks.k) AS py FROM en JOIN ks ON ks.dataset_name = en.dataset_name AND ks.k BETWEEN start_index AND end_index),
mi AS (SELECT *, row_number() OVER (PARTITION BY dataset_name, segment_id ORDER BY k) AS nth FROM cu WHERE k > start_index AND step > 0 AND along >= size / 2), sp AS (SELECT dataset_name, segment_id, px + (size / 2 - (along - step)) / step * (lon - px) AS lon, py + (size / 2 - (along - step)) / step * (lat - py) AS lat FROM mi WHERE nth = 1),
ed AS (SELECT dataset_name, segment_id, arg_min(lon, k) AS x1, arg_min(lat, k) AS y1, arg_max(lon, k) AS x2, arg_max(lat, k) AS y2 FROM cu GROUP BY 1, 2),
pc AS (SELECT en.dataset_name, CAST(segment_id AS INT) AS segment_id, start_index, end_index, size * 111320 AS length_meters, lon, lat, CASE WHEN size * 111320 >= 10 THEN {HEADING} END AS heading FROM en JOIN sp USING (dataset_name, segment_id) JOIN ed USING (dataset_name, segment_id))"""


@query("g17_input_segments", "pts", sql=f"WITH {PIECES} SELECT dataset_name, segment_id, CAST(start_index AS INT) AS start_index, CAST(end_index AS INT) AS end_index, round(length_meters, 3) AS length_meters, round(lon, 7) AS lon, round(lat, 7) AS lat, round(heading, 3) AS heading FROM pc")
def g17(pts):
    return W.input_segments(pts).select("dataset_name", "segment_id", "start_index", "end_index", F.round("length_meters", 3).alias("length_meters"), F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"), F.round("heading", 3).alias("heading"))


LANES = f"""ln AS (SELECT intersection_id AS lane_id, xmin AS x1, ymin AS y1, xmax AS x2, ymax AS y2 FROM crossings), lh AS (SELECT *, {HEADING} AS way FROM ln),
nn AS (SELECT pc.*, lh.*, greatest(0, least(1, ((lon - x1) * (x2 - x1) + (lat - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2))) AS t FROM pc JOIN lh ON lon BETWEEN x1 - {radius(50)} AND x2 + {radius(50)} AND lat BETWEEN y1 - {radius(50)} AND y2 + {radius(50)}),
nd AS (SELECT *, sqrt((lon - (x1 + t * (x2 - x1))) ** 2 + (lat - (y1 + t * (y2 - y1))) ** 2) AS distance FROM nn), nk AS (SELECT *, row_number() OVER (PARTITION BY dataset_name, segment_id ORDER BY distance, lane_id) AS nth FROM nd WHERE distance <= {radius(50)}::DOUBLE),
nh AS (SELECT *, {TURN.format(a='heading', b='way')} AS hd FROM nk WHERE nth <= 10)"""


@query("g16_candidate_lanes", "pts", "crossings", sql=f"WITH {PIECES}, {LANES} SELECT dataset_name, lane_id, round(min(distance) * 111320, 3) AS metres FROM nh WHERE heading IS NULL OR hd <= 45 GROUP BY 1, 2")
def g16(pts, crossings):
    found = W.candidate_lanes(W.input_segments(pts), lanes_of(crossings))
    return found.select("dataset_name", "lane_id", F.round(F.col("distance") * METRES_PER_DEGREE, 3).alias("metres"))


#: Every other lane leads more to the east, as the trajectories do.
FLAT = "flat AS (SELECT * REPLACE (CASE WHEN intersection_id % 2 = 0 THEN ymin + (ymax - ymin) / 2 ELSE ymax END AS ymax) FROM crossings)"


def flat(crossings):
    return crossings.withColumn("ymax", F.when(F.col("intersection_id") % 2 == 0, F.col("ymin") + (F.col("ymax") - F.col("ymin")) / 2).otherwise(F.col("ymax")))


@query("g27_complete_trajectories", "pts", "crossings", sql=f"""WITH {FLAT}, {NEAR.format(r=radius(15)).replace('crossings l', 'flat l')}, a AS (SELECT dataset_name, count(*) AS hit_points, count(DISTINCT lane_id) AS total_lanes FROM h GROUP BY 1), k AS (SELECT *, CASE WHEN total_lanes >= 2 THEN concat('multi_lane_', total_lanes, '_lanes') ELSE concat('sufficient_points_', hit_points, '_points') END AS reason FROM a WHERE total_lanes >= 2 OR hit_points >= 5),
st AS (SELECT *, sqrt((lon - lag(lon) OVER w) * (lon - lag(lon) OVER w) + (lat - lag(lat) OVER w) * (lat - lag(lat) OVER w)) AS step FROM pts WINDOW w AS (PARTITION BY dataset_name ORDER BY ts, seq)),
o AS (SELECT dataset_name, min(ts) AS start_time, max(ts) AS end_time, count(*) AS total_points, coalesce(sum(step), 0) * 111320 AS length_meters, arg_min(lon, seq) AS x1, arg_min(lat, seq) AS y1, arg_max(lon, seq) AS x2, arg_max(lat, seq) AS y2 FROM st GROUP BY 1 HAVING count(*) >= 2),
q AS (SELECT *, CASE WHEN length_meters >= 10 THEN {HEADING} END AS hd FROM o), l AS (SELECT DISTINCT dataset_name, lane_id, xmin AS x1, ymin AS y1, xmax AS x2, ymax AS y2 FROM h), m AS (SELECT dataset_name, lane_id, {HEADING} AS hl FROM l)
SELECT q.dataset_name, start_time, end_time, total_points, round(length_meters, 2) AS length_meters, hit_points, total_lanes, reason, round(hd, 3) AS trajectory_heading FROM q JOIN k USING (dataset_name) WHERE hd IS NULL OR EXISTS (SELECT 1 FROM m WHERE m.dataset_name = q.dataset_name AND {TURN.format(a='hl', b='hd')} <= 45)""")
def g27(pts, crossings):
    found = W.complete_trajectories(pts, lanes_of(flat(crossings)))
    return found.select("dataset_name", "start_time", "end_time", "total_points", F.round("length_meters", 2).alias("length_meters"), "hit_points", "total_lanes", "reason", F.round("trajectory_heading", 3).alias("trajectory_heading"))


@query("h5_scene_mapping", "events", sql="""SELECT scene_id, dataset_name, CAST(event_id AS INT) AS event_id, event_type AS event_name FROM (SELECT concat('scene_', user_id) AS scene_id, concat('traj_', user_id) AS dataset_name, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, concat(event_id, '.0') DESC) AS r FROM events) WHERE r = 1""")
def h5(events):
    number = F.col("user_id").cast("string")
    rows = events.select(F.concat(F.lit("scene_"), number).alias("scene_id"), F.concat(F.lit("traj_"), number).alias("dataset_name"), F.concat(F.col("event_id").cast("string"), F.lit(".0")).alias("event_id"), F.col("event_type").alias("event_name"), F.col("ts").alias("updated_time"))
    return W.scene_mapping(rows)


@query("h10_segmented_records", "pts", "documents", sql=f"""WITH {CLEAN}, vv AS (SELECT dataset_name, autoscene_id, x.k AS range_no, CASE x.k WHEN 0 THEN CAST(autoscene_id % 5 AS DOUBLE) ELSE 20 END AS lo, CASE x.k WHEN 0 THEN CAST(autoscene_id % 5 + 2.5 AS DOUBLE) ELSE 31 END AS hi FROM k, range(0, 2) AS x(k)),
t AS (SELECT dataset_name, seq, ts - min(ts) OVER (PARTITION BY dataset_name) AS a, max(ts) OVER (PARTITION BY dataset_name) - min(ts) OVER (PARTITION BY dataset_name) AS d FROM pts),
m AS (SELECT t.*, autoscene_id, range_no, greatest(0.5, ceil(greatest(lo - a, a - hi, 0) / 0.5) * 0.5) AS need FROM t JOIN vv USING (dataset_name) WHERE hi >= 0 AND lo <= d),
c AS (SELECT autoscene_id, count(*) AS n FROM (SELECT autoscene_id, range_no FROM m WHERE need <= least(5, 0.1 * d) GROUP BY 1, 2 HAVING count(*) >= 2) GROUP BY 1),
wh AS (SELECT dataset_name, count(*) AS total_points, min(ts) AS start_time, max(ts) AS end_time, CAST(max(ts) - min(ts) AS DOUBLE) / CASE WHEN max(ts) - min(ts) < 1000 THEN 1 WHEN max(ts) - min(ts) < 100000 THEN 1000 WHEN max(ts) - min(ts) < 100000000 THEN 1000000 ELSE 1000000000 END AS total_duration FROM pts GROUP BY 1 HAVING count(*) >= 2)
SELECT k.autoscene_id, k.dataset_name, coalesce(c.n, 0) AS segment_count, total_points, start_time, end_time, round(total_duration, 6) AS total_duration FROM k JOIN wh USING (dataset_name) LEFT JOIN c ON c.autoscene_id = k.autoscene_id""")
def h10(pts, documents):
    return W.segmented_records(pts, H.cleaned(records(documents))).drop("merged_results").withColumn("total_duration", F.round("total_duration", 6))


CUT = f"""{CLEAN}, vv AS (SELECT dataset_name, autoscene_id, x.k AS range_no, CASE x.k WHEN 0 THEN CAST(autoscene_id % 5 AS DOUBLE) ELSE 20 END AS lo, CASE x.k WHEN 0 THEN CAST(autoscene_id % 5 + 2.5 AS DOUBLE) ELSE 31 END AS hi FROM k, range(0, 2) AS x(k)),
t AS (SELECT dataset_name, seq, lon, ts, ts - min(ts) OVER (PARTITION BY dataset_name) AS a, max(ts) OVER (PARTITION BY dataset_name) - min(ts) OVER (PARTITION BY dataset_name) AS d FROM pts),
m AS (SELECT t.*, autoscene_id, range_no, greatest(0.5, ceil(greatest(lo - a, a - hi, 0) / 0.5) * 0.5) AS need FROM t JOIN vv USING (dataset_name) WHERE hi >= 0 AND lo <= d)"""


@query("h9_record_lines", "pts", "documents", sql=f"""WITH {CUT}, tol AS (SELECT autoscene_id, range_no, min(level) AS level FROM (SELECT autoscene_id, range_no, level, count(*) FILTER (need <= level) AS held FROM m, (SELECT 0.5 * x AS level FROM range(1, 11) AS y(x)) WHERE level <= least(5, 0.1 * d) GROUP BY 1, 2, 3) WHERE held >= 2 GROUP BY 1, 2),
pc AS (SELECT m.autoscene_id, m.range_no, count(*) AS n, arg_min(lon, seq) AS lon FROM m JOIN tol ON tol.autoscene_id = m.autoscene_id AND tol.range_no = m.range_no AND need <= level GROUP BY 1, 2 HAVING count(*) >= 2), c AS (SELECT autoscene_id, count(*) AS n, CAST(sum(n) AS BIGINT) AS points, arg_min(lon, range_no) AS lon FROM pc GROUP BY 1),
wh AS (SELECT dataset_name, count(*) AS points, arg_min(lon, seq) AS lon, round_even(avg(twist_linear), 2) AS avg_speed FROM pts GROUP BY 1 HAVING count(*) >= 2)
SELECT k.autoscene_id, k.dataset_name, coalesce(c.n, 0) AS segment_count, coalesce(c.n, 1) AS line_count, coalesce(c.points, wh.points) AS line_points, round(coalesce(c.lon, wh.lon), 7) AS first_lon, c.n IS NULL AS whole, avg_speed FROM k JOIN wh USING (dataset_name) LEFT JOIN c ON c.autoscene_id = k.autoscene_id""")
def h9(pts, documents):
    found = W.record_lines(pts, H.cleaned(records(documents)))
    points = F.aggregate("lines", F.lit(0).cast("long"), lambda n, x: n + F.size(x))
    first = F.round(F.get(F.get("lines", F.lit(0)), F.lit(0))["lon"], 7)
    return found.select("autoscene_id", "dataset_name", "segment_count", F.size("lines").cast("long").alias("line_count"), points.alias("line_points"), first.alias("first_lon"), "whole", "avg_speed")


@query("g31_lane_statistics", "pts", "crossings", sql=f"""WITH {FLAT}, {PIECES}, {LANES.replace('FROM crossings', 'FROM flat')}, {NEAR.format(r=radius(15)).replace('crossings l', 'flat l').replace('n AS (SELECT', 'n_ AS (SELECT').replace('FROM n)', 'FROM n_)')}, ca AS (SELECT dataset_name, count(DISTINCT lane_id) AS lanes FROM nh WHERE heading IS NULL OR hd <= 45 GROUP BY 1),
a AS (SELECT dataset_name, count(*) AS hits, count(DISTINCT seq) AS points, count(DISTINCT lane_id) AS lane_count FROM h GROUP BY 1), e AS (SELECT dataset_name FROM pts GROUP BY 1 HAVING count(*) >= 2),
st AS (SELECT *, sqrt((lon - lag(lon) OVER w) * (lon - lag(lon) OVER w) + (lat - lag(lat) OVER w) * (lat - lag(lat) OVER w)) AS step FROM pts WINDOW w AS (PARTITION BY dataset_name ORDER BY ts, seq)),
o AS (SELECT dataset_name, coalesce(sum(step), 0) * 111320 AS length_meters, arg_min(lon, seq) AS x1, arg_min(lat, seq) AS y1, arg_max(lon, seq) AS x2, arg_max(lat, seq) AS y2 FROM st GROUP BY 1 HAVING count(*) >= 2), q AS (SELECT *, CASE WHEN length_meters >= 10 THEN {HEADING} END AS hd FROM o),
l AS (SELECT DISTINCT dataset_name, lane_id, xmin AS x1, ymin AS y1, xmax AS x2, ymax AS y2 FROM h), mm AS (SELECT dataset_name, {HEADING} AS hl FROM l),
co AS (SELECT q.dataset_name FROM q JOIN a USING (dataset_name) WHERE (lane_count >= 2 OR hits >= 5) AND (hd IS NULL OR EXISTS (SELECT 1 FROM mm WHERE mm.dataset_name = q.dataset_name AND {TURN.format(a='hl', b='hd')} <= 45))),
r AS (SELECT e.dataset_name, coalesce(ca.lanes, 0) AS lanes, coalesce(a.points, 0) AS points, CASE WHEN lane_count >= 2 THEN 1 ELSE 0 END AS multi, CASE WHEN lane_count < 2 AND hits >= 5 THEN 1 ELSE 0 END AS enough, CASE WHEN co.dataset_name IS NULL THEN 0 ELSE 1 END AS complete FROM e LEFT JOIN ca USING (dataset_name) LEFT JOIN a USING (dataset_name) LEFT JOIN co ON co.dataset_name = e.dataset_name)
SELECT count(*) AS input_trajectories_analyzed, CAST(sum(lanes) AS BIGINT) AS total_candidate_lanes, CAST(sum(points) AS BIGINT) AS total_trajectory_points, CAST(sum(complete) AS BIGINT) AS total_complete_trajectories, CAST(sum(multi) AS BIGINT) AS total_multi_lane_trajectories, CAST(sum(enough) AS BIGINT) AS total_sufficient_points_trajectories,
  round(sum(lanes) / count(*), 2) AS avg_candidate_lanes_per_input, round(sum(points) / count(*), 2) AS avg_trajectory_points_per_input, round(sum(complete) / count(*), 2) AS avg_complete_trajectories_per_input, round((sum(multi) + sum(enough)) * 100.0::DOUBLE / count(*), 2) AS filter_efficiency_percentage FROM r""")
def g31(pts, crossings):
    return W.lane_statistics(pts, lanes_of(flat(crossings)))


@query("g38_lane_availability", "edges", sql="""WITH c AS (SELECT nextroadid % 50 AS analysis_id, count(*) AS lane_count FROM edges GROUP BY 1), t AS (SELECT * FROM c ORDER BY lane_count DESC, analysis_id LIMIT 5)
SELECT 'known' AS kind, analysis_id, lane_count, true AS asked FROM c WHERE analysis_id = 7 UNION ALL SELECT 'unknown', analysis_id, lane_count, false FROM t""")
def g38(edges):
    lanes = edges.select((F.col("nextroadid") % 50).alias("analysis_id"))
    return R.lane_availability(lanes, 7).withColumn("kind", F.lit("known")).unionByName(R.lane_availability(lanes, 777).withColumn("kind", F.lit("unknown")))


@query("g12_analysis_summary", "edges", sql="""SELECT nextroadid % 10 AS analysis_id, count(DISTINCT roadid) AS total_roads, count(*) FILTER (roadid % 3 = 0) AS direct_roads, count(*) FILTER (roadid % 3 = 1) AS chain_roads, count(*) FILTER (roadid % 3 = 2) AS intersection_roads, CAST(sum(roadid % 4) AS BIGINT) AS total_lanes, round(sum(length), 3) AS total_length FROM edges GROUP BY 1""")
def g12(edges):
    kind = F.element_at(F.array(F.lit("direct"), F.lit("chain"), F.lit("intersection")), (F.col("roadid") % 3 + 1).cast("int"))
    return R.road_summary(edges.select((F.col("nextroadid") % 10).alias("analysis_id"), F.col("roadid").alias("road_id"), kind.alias("kind"), (F.col("roadid") % 4).alias("lane_count"), "length"))


@query("b16_partition_tables", "scenes", sql="""WITH t AS (SELECT *, concat(CASE doc_id % 7 WHEN 0 THEN 'clips_bbox_' WHEN 1 THEN 'clips_bbox' WHEN 2 THEN 'clips_bbox_Unified_' WHEN 3 THEN 'other_' ELSE 'clips_bbox_' END, subdataset_name, CASE doc_id % 7 WHEN 4 THEN '_tmp' WHEN 5 THEN '_backup' WHEN 6 THEN '_bad' ELSE '' END) AS table_name, CASE WHEN doc_id % 7 = 6 AND lang = 'en' THEN 'defect' ELSE 'normal' END AS data_type FROM scenes)
SELECT DISTINCT table_name FROM t WHERE starts_with(table_name, 'clips_bbox_') AND NOT regexp_matches(lower(table_name), 'unified|temp|backup|test|tmp') AND table_name NOT IN (SELECT table_name FROM t WHERE data_type = 'defect')""")
def b16(scenes):
    k = F.col("doc_id") % 7
    name = F.concat(F.when(k == 1, "clips_bbox").when(k == 2, "clips_bbox_Unified_").when(k == 3, "other_").otherwise("clips_bbox_"), "subdataset_name", F.when(k == 4, "_tmp").when(k == 5, "_backup").when(k == 6, "_bad").otherwise(""))
    rows = scenes.select(name.alias("table_name"), F.when((k == 6) & (F.col("lang") == "en"), "defect").otherwise("normal").alias("data_type"))
    return D.partition_tables(rows.select("table_name"), rows)


def areas(crossings):
    return crossings.where("intersectiontype = 5").select(F.col("intersection_id").alias("polygon_id"), F.concat(F.lit("set"), F.col("intersectionsubtype").cast("string"), F.lit(":"), F.col("intersection_id").cast("string")).alias("source"), "xmin", "ymin", "xmax", "ymax")


AREAS = "ar AS (SELECT intersection_id AS polygon_id, concat('set', intersectionsubtype, ':', intersection_id) AS source, xmin, ymin, xmax, ymax FROM crossings WHERE intersectiontype = 5), so AS (SELECT dataset_name, seq, string_agg(source, ',' ORDER BY polygon_id) AS told FROM pts JOIN ar ON lon BETWEEN xmin AND xmax AND lat BETWEEN ymin AND ymax GROUP BY 1, 2), ps AS (SELECT pts.*, coalesce(told, concat('polygon_', (SELECT min(polygon_id) FROM ar))) AS source_polygons FROM pts LEFT JOIN so USING (dataset_name, seq))"


@query("i8_point_sources", "pts", "crossings", sql=f"WITH {AREAS} SELECT dataset_name, seq, source_polygons FROM ps")
def i8(pts, crossings):
    return W.point_sources(pts, areas(crossings)).select("dataset_name", "seq", "source_polygons")


@query("i11_result_rows", "pts", "crossings", sql=f"WITH {AREAS} SELECT dataset_name, min(ts) AS start_time, max(ts) AS end_time, count(*) AS point_count, arg_min(source_polygons, seq) AS source_polygons, 'text' AS query_type FROM ps GROUP BY 1 HAVING count(*) >= 2")
def i11(pts, crossings):
    found = W.result_rows(pts, areas=areas(crossings))
    return found.select("dataset_name", "start_time", "end_time", "point_count", "source_polygons", "query_type")


@query("e19_quality_summary", "boxes", sql=ALL + """SELECT city_id, count(*) AS total_hotspots, max(bbox_count) AS most, min(bbox_count) AS least, round(avg(bbox_count), 2) AS mean, CAST(sum(bbox_count) AS BIGINT) AS total, max(subdataset_count) AS most_subdatasets, round(avg(scene_count), 2) AS mean_scenes, count(*) FILTER (bbox_count >= 10) AS high, count(*) FILTER (bbox_count >= 5 AND bbox_count < 10) AS medium, count(*) FILTER (bbox_count < 5) AS low,
CASE WHEN count(*) >= 10 AND max(bbox_count) >= 5 THEN 'High Quality' WHEN count(*) >= 5 AND max(bbox_count) >= 3 THEN 'Medium Quality' ELSE 'Low Quality' END AS analysis_quality FROM d GROUP BY 1""")
def e19(boxes):
    n = F.col("bbox_count")
    quality = F.when((F.count("*") >= 10) & (F.max(n) >= 5), "High Quality").when((F.count("*") >= 5) & (F.max(n) >= 3), "Medium Quality").otherwise("Low Quality")
    return E.density(boxes, least=1).groupBy("city_id").agg(
        F.count("*").alias("total_hotspots"), F.max(n).alias("most"), F.min(n).alias("least"), F.round(F.avg(n), 2).alias("mean"), F.sum(n).alias("total"), F.max("subdataset_count").alias("most_subdatasets"), F.round(F.avg("scene_count"), 2).alias("mean_scenes"),
        F.count_if(n >= 10).alias("high"), F.count_if((n >= 5) & (n < 10)).alias("medium"), F.count_if(n < 5).alias("low"), quality.alias("analysis_quality"),
    )


@query("c12_city_centroids", "boxes", sql="SELECT city_id, round(sum((xmax - xmin) * (ymax - ymin) * (xmin + xmax) / 2) / sum((xmax - xmin) * (ymax - ymin)), 6) AS lon, round(sum((xmax - xmin) * (ymax - ymin) * (ymin + ymax) / 2) / sum((xmax - xmin) * (ymax - ymin)), 6) AS lat FROM boxes GROUP BY 1")
def c12(boxes):
    area = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))
    mean = lambda a, b: F.round(F.sum(area * (F.col(a) + F.col(b)) / 2) / F.sum(area), 6)
    return boxes.groupBy("city_id").agg(mean("xmin", "xmax").alias("lon"), mean("ymin", "ymax").alias("lat"))
