"""Further queries: loading, mapping, cells, scaled features, line distances, buffers, roll-ups."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tracelake.functions import text
from tracelake.functions.geo import METRES_PER_DEGREE, haversine, point_segment_distance, shoelace
from tracelake.operators import boxes as B
from tracelake.operators import datasets as D
from tracelake.operators import density as E
from tracelake.operators import media as M
from tracelake.operators import roads as R
from tracelake.operators import trajectories as T
from tracelake.plans.motion import HAV, KEY, SEGS, STEP, segs
from tracelake.plans.places import ALL, JOIN, case
from tracelake.plans.registry import query
from tracelake.plans.roads import NEAR, TOLL, lanes_of, radius, stations


@query("a13_loaded_subdatasets", "scenes", sql="SELECT subdataset_name, duplication_factor, count(*) AS scenes, arg_min(lang, doc_id) AS metadata FROM scenes GROUP BY 1, 2")
def a13(scenes):
    return scenes.groupBy("subdataset_name", "duplication_factor").agg(F.count("*").alias("scenes"), F.min_by("lang", "doc_id").alias("metadata"))


@query("a16_scene_list_with_duplicates", "scenes", sql="SELECT scene_id FROM (SELECT scene_id, unnest(range(0, duplication_factor)) AS i FROM scenes WHERE subdataset_name = 'src10')")
def a16(scenes):
    return D.duplicated(D.matching(scenes, subdataset_name="src10")).select("scene_id")


@query("a20_scenes_by_subdataset", "scenes", sql="SELECT subdataset_name, array_to_string(list_sort(list(scene_id)), ' ') AS scenes FROM scenes GROUP BY 1")
def a20(scenes):
    return scenes.groupBy("subdataset_name").agg(F.array_join(F.array_sort(F.collect_list("scene_id")), " ").alias("scenes"))


@query("b4_all_good", "pts", sql="SELECT dataset_name, bool_and(workstage = 2) AS all_good, count(*) FILTER (workstage <> 2) AS others FROM pts GROUP BY 1")
def b4(pts):
    return pts.groupBy("dataset_name").agg(F.bool_and(F.col("workstage") == 2).alias("all_good"), F.count_if(F.col("workstage") != 2).alias("others"))


@query("c10_labels_in_use", "crossings", sql=f"SELECT DISTINCT intersectiontype, {case('intersectiontype', B.TYPES)} AS type_name FROM crossings")
def c10(crossings):
    return crossings.select("intersectiontype").distinct().withColumn("type_name", B.label(F.col("intersectiontype"), B.TYPES))


@query("c14_exported_analysis", "boxes", "crossings", sql=f"SELECT 'city_id' AS group_dimension, b.city_id AS group_value, b.city_id AS group_name, count(*) AS intersection_count, '{{\"kind\":\"city\"}}' AS analysis_params FROM {JOIN} GROUP BY b.city_id")
def c14(boxes, crossings):
    return B.named_result(B.analysed(boxes, crossings, ("city_id",)), "city_id", {"kind": "city"})


@query("d1_scene_mappings", "scenes", "pts", sql="SELECT s.scene_id, s.lang, p.dataset_name FROM scenes s LEFT JOIN (SELECT DISTINCT scene_token, dataset_name FROM pts) p ON p.scene_token = s.scene_id")
def d1(scenes, pts):
    names = pts.select(F.col("scene_token").alias("scene_id"), "dataset_name").distinct()
    return scenes.join(names, "scene_id", "left").select("scene_id", "lang", "dataset_name")


@query("d4_filled_names", "scenes", "pts", sql="SELECT s.scene_id, coalesce(p.dataset_name, concat('missing_', s.doc_id)) AS data_name FROM scenes s LEFT JOIN (SELECT DISTINCT scene_token, dataset_name FROM pts) p ON p.scene_token = s.scene_id")
def d4(scenes, pts):
    names = pts.select(F.col("scene_token").alias("scene_id"), "dataset_name").distinct()
    return scenes.join(names, "scene_id", "left").select("scene_id", F.coalesce("dataset_name", F.concat(F.lit("missing_"), "doc_id")).alias("data_name"))


@query("e3_cell_ranges", "boxes", sql="SELECT scene_token, CAST(floor(xmin / 0.002) AS BIGINT) AS gx0, CAST(floor(xmax / 0.002) AS BIGINT) AS gx1, CAST(floor(ymin / 0.002) AS BIGINT) AS gy0, CAST(floor(ymax / 0.002) AS BIGINT) AS gy1 FROM boxes")
def e3(boxes):
    at = lambda c: F.floor(F.col(c) / E.CELL).cast("long")
    return boxes.select("scene_token", at("xmin").alias("gx0"), at("xmax").alias("gx1"), at("ymin").alias("gy0"), at("ymax").alias("gy1"))


@query("e22_cities_with_good", "boxes", sql="SELECT city_id, count(*) AS total, count(*) FILTER (all_good) AS good FROM boxes GROUP BY 1")
def e22(boxes):
    return boxes.groupBy("city_id").agg(F.count("*").alias("total"), F.count_if("all_good").alias("good"))


@query("e24_time_estimate", "boxes", sql="SELECT count(*) FILTER (all_good) AS good, CASE WHEN count(*) FILTER (all_good) > 1000 THEN '< 2分钟' ELSE '< 30秒' END AS estimate FROM boxes")
def e24(boxes):
    good = F.count_if("all_good")
    return boxes.agg(good.alias("good")).withColumn("estimate", E.banded(F.col("good")))


@query("f6_step_distances", "pts", sql=f"WITH {STEP} SELECT dataset_name, seq, round(step, 3) AS step FROM s WHERE step IS NOT NULL")
def f6(pts):
    return T.steps(pts).where("step is not null").select("dataset_name", "seq", F.round("step", 3).alias("step"))


@query("f12_points_of_hot_cells", "pts", "boxes", sql=ALL + "SELECT p.dataset_name, p.seq FROM pts p JOIN r ON r.hot_rank = 1 AND r.city_id = p.city_id AND floor(p.lon / 0.002) = r.grid_x AND floor(p.lat / 0.002) = r.grid_y")
def f12(pts, boxes):
    top = E.ranked(E.density(boxes, least=1), "city_id").where("hot_rank = 1").select("city_id", "grid_x", "grid_y")
    cell = pts.withColumns({"grid_x": F.floor(F.col("lon") / E.CELL).cast("long"), "grid_y": F.floor(F.col("lat") / E.CELL).cast("long")})
    return cell.join(top, ["city_id", "grid_x", "grid_y"]).select("dataset_name", "seq")


@query("f15_valid_segments", "pts", sql=f"WITH {SEGS} SELECT dataset_name, segment_index FROM z WHERE quality_flag IN ('moving', 'stationary')")
def f15(pts):
    return T.valid(segs(pts)).select(*KEY)


@query("f14_cell_counters", "pts", sql=f"WITH {SEGS} SELECT substr(dataset_name, 6, 1) AS grid_id, count(*) AS segments, count(*) FILTER (quality_flag IN ('moving', 'stationary')) AS valid, count(DISTINCT dataset_name) AS trajectories FROM z GROUP BY 1")
def f14(pts):
    good = F.col("quality_flag").isin("moving", "stationary")
    return segs(pts).groupBy(F.substring("dataset_name", 6, 1).alias("grid_id")).agg(F.count("*").alias("segments"), F.count_if(good).alias("valid"), F.countDistinct("dataset_name").alias("trajectories"))


@query("f24_scaled_features", "pts", sql=f"WITH {SEGS} SELECT dataset_name, segment_index, round((avg_speed - avg(avg_speed) OVER ()) / stddev_pop(avg_speed) OVER (), 5) AS avg_speed, round((max_speed - avg(max_speed) OVER ()) / stddev_pop(max_speed) OVER (), 5) AS max_speed FROM z")
def f24(pts):
    rows = T.scaled(segs(pts).select(*KEY, "avg_speed", "max_speed"), columns=("avg_speed", "max_speed"))
    return rows.select(*KEY, F.round("avg_speed", 5).alias("avg_speed"), F.round("max_speed", 5).alias("max_speed"))


CHORD = "c AS (SELECT dataset_name, arg_min(lon, seq) AS x1, arg_min(lat, seq) AS y1, arg_max(lon, seq) AS x2, arg_max(lat, seq) AS y2 FROM pts GROUP BY 1)"


def chords(pts):
    ends = (("x1", F.min_by, "lon"), ("y1", F.min_by, "lat"), ("x2", F.max_by, "lon"), ("y2", F.max_by, "lat"))
    return pts.groupBy("dataset_name").agg(*[f(c, "seq").alias(n) for n, f, c in ends])


@query("f27_offsets_from_chord", "pts", sql=f"""WITH {CHORD}, d AS (SELECT dataset_name, lon, lat, x1, y1, x2, y2, greatest(0, least(1, ((lon - x1) * (x2 - x1) + (lat - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2))) AS t FROM pts JOIN c USING (dataset_name))
SELECT dataset_name, round(max(sqrt((lon - x1 - t * (x2 - x1)) ** 2 + (lat - y1 - t * (y2 - y1)) ** 2)) * 111320, 3) AS widest FROM d GROUP BY 1""")
def f27(pts):
    d = point_segment_distance(F.col("lon"), F.col("lat"), *[F.col(c) for c in ("x1", "y1", "x2", "y2")])
    return pts.join(chords(pts), "dataset_name").groupBy("dataset_name").agg(F.round(F.max(d) * METRES_PER_DEGREE, 3).alias("widest"))


@query("f30_turn_between_neighbours", "pts", sql=f"""WITH {CHORD}, v AS (SELECT CAST(substr(dataset_name, 6) AS INT) AS k, x2 - x1 AS x, y2 - y1 AS y FROM c)
SELECT a.k, round(acos(greatest(-1, least(1, (a.x * b.x + a.y * b.y) / (sqrt(a.x ** 2 + a.y ** 2) * sqrt(b.x ** 2 + b.y ** 2))))), 4) AS angle FROM v a JOIN v b ON b.k = a.k + 1""")
def f30(pts):
    v = chords(pts).select(F.substring("dataset_name", 6, 9).cast("int").alias("k"), (F.col("x2") - F.col("x1")).alias("x"), (F.col("y2") - F.col("y1")).alias("y"))
    w = v.select((F.col("k") - 1).alias("k"), F.col("x").alias("u"), F.col("y").alias("w"))
    size = lambda a, b: F.sqrt(F.col(a) * F.col(a) + F.col(b) * F.col(b))
    cosine = (F.col("x") * F.col("u") + F.col("y") * F.col("w")) / (size("x", "y") * size("u", "w"))
    return v.join(w, "k").select("k", F.round(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))), 4).alias("angle"))


@query("f39_datasets_of_cell", "boxes", sql="SELECT DISTINCT dataset_name FROM boxes WHERE all_good AND floor(xmin / 0.002) = floor(116.302 / 0.002::DOUBLE)")
def f39(boxes):
    cell = F.floor(F.col("xmin") / E.CELL) == F.floor(F.lit(116.302) / E.CELL)
    return boxes.where(F.col("all_good") & cell).select("dataset_name").distinct()


@query("g3_crossings_near_trajectories", "pts", "crossings", sql=f"SELECT DISTINCT p.dataset_name, c.intersection_id FROM pts p JOIN crossings c ON c.intersectiontype = 5 AND greatest(0, c.xmin - p.lon, p.lon - c.xmax) ** 2 + greatest(0, c.ymin - p.lat, p.lat - c.ymax) ** 2 <= {radius(3)}::DOUBLE * {radius(3)}::DOUBLE")
def g3(pts, crossings):
    some = crossings.where("intersectiontype = 5")
    return R.named(R.touched_boxes(pts, some, 3.0), some, "intersection_id")


@query("g12_road_totals", "edges", sql="SELECT count(*) AS edges, count(DISTINCT nextroadid) AS roads, round(sum(length), 2) AS metres FROM edges")
def g12(edges):
    return edges.agg(F.count("*").alias("edges"), F.countDistinct("nextroadid").alias("roads"), F.round(F.sum("length"), 2).alias("metres"))


@query("g17_pieces_of_fifty_metres", "pts", sql=f"""WITH s AS (SELECT *, sqrt((lon - x) ** 2 + (lat - y) ** 2) AS step FROM (SELECT *, lag(lon) OVER w AS x, lag(lat) OVER w AS y FROM pts WINDOW w AS (PARTITION BY dataset_name ORDER BY ts, seq))),
a AS (SELECT dataset_name, seq, CAST(floor(coalesce(sum(step) OVER (PARTITION BY dataset_name ORDER BY ts, seq), 0) / {radius(50)}::DOUBLE) AS BIGINT) AS piece FROM s) SELECT dataset_name, piece, count(*) AS points FROM a GROUP BY 1, 2""")
def g17(pts):
    w = Window.partitionBy("dataset_name").orderBy("ts", "seq")
    dx, dy = F.col("lon") - F.lag("lon").over(w), F.col("lat") - F.lag("lat").over(w)
    along = F.coalesce(F.sum("step").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0.0))
    cut = pts.withColumn("step", F.sqrt(dx * dx + dy * dy)).withColumn("piece", F.floor(along / (50 / METRES_PER_DEGREE)).cast("long"))
    return cut.groupBy("dataset_name", "piece").agg(F.count("*").alias("points"))


@query("g22_tolls_with_results", "pts", "crossings", sql=f"SELECT t.intersection_id, t.intersectionsubtype, coalesce(h.points, 0) AS points FROM (SELECT * FROM crossings WHERE intersectiontype = 2) t LEFT JOIN (SELECT c.intersection_id, count(*) AS points FROM {TOLL} GROUP BY 1) h ON h.intersection_id = t.intersection_id")
def g22(pts, crossings):
    found = stations(pts, crossings).groupBy(F.col("polygon_id").alias("intersection_id")).agg(F.count("*").alias("points"))
    return crossings.where("intersectiontype = 2").join(found, "intersection_id", "left").select("intersection_id", "intersectionsubtype", F.coalesce("points", F.lit(0)).alias("points"))


@query("g29_polygon_areas", "crossings", sql="SELECT intersection_id, round((xmax - xmin) * (ymax - ymin) * 111320.0::DOUBLE * 111320, 1) AS square_metres FROM crossings")
def g29(crossings):
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ring = F.array(corner("xmin", "ymin"), corner("xmax", "ymin"), corner("xmax", "ymax"), corner("xmin", "ymax"))
    return crossings.select("intersection_id", F.round(shoelace(ring) * METRES_PER_DEGREE * METRES_PER_DEGREE, 1).alias("square_metres"))


@query("g35_lane_run_statistics", "pts", "crossings", sql=f"WITH {NEAR.format(r=radius(15))} SELECT count(*) AS hits, count(DISTINCT dataset_name) AS datasets, count(DISTINCT lane_id) AS lanes, round(avg(distance) * 111320, 3) AS mean_metres FROM h")
def g35(pts, crossings):
    near = R.near_lanes(pts.select("dataset_name", "lon", "lat"), R.lane_classes(lanes_of(crossings)), 15)
    n = F.greatest("lanes", F.lit(1))
    per = near.groupBy("lane_id").agg(F.max("lanes").alias("lanes"), F.sum(n).alias("hits"), F.sum(F.col("distance") * n).alias("far"))
    sums = per.agg(F.coalesce(F.sum("hits"), F.lit(0)).alias("hits"), F.coalesce(F.sum("lanes"), F.lit(0)).alias("lanes"), F.sum("far").alias("far"))
    datasets = near.agg(F.countDistinct("dataset_name").alias("datasets"))  # one row, as the sums are
    return sums.crossJoin(F.broadcast(datasets)).select("hits", "datasets", "lanes", F.round(F.col("far") / F.nullif("hits", F.lit(0)) * METRES_PER_DEGREE, 3).alias("mean_metres"))


@query("g41_coerced_results", "documents", sql="SELECT doc_id, TRY_CAST(substr(source, 4) AS INT) AS source_number, coalesce(lang = 'en', false) AS english, coalesce(lang, '') AS lang FROM documents")
def g41(documents):
    return documents.select("doc_id", F.substring("source", 4, 10).try_cast("int").alias("source_number"), F.coalesce(F.col("lang") == "en", F.lit(False)).alias("english"), F.coalesce("lang", F.lit("")).alias("lang"))


#: A text's bytes in two encodings, read as Latin-1 (fixed values).
BROKEN = {"utf": bytes("质检 ", "utf-8").decode("latin-1"), "gbk": bytes("轨迹 ", "gbk").decode("latin-1")}


@query("h12_repaired_text", "documents", sql="SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN concat('质检 ', doc_id) WHEN 1 THEN concat('轨迹 ', doc_id) ELSE lang END AS label FROM documents")
def h12(documents):
    n = F.col("doc_id") % 3
    broken = F.when(n == 0, F.concat(F.lit(BROKEN["utf"]), F.col("doc_id").cast("string"))).when(n == 1, F.concat(F.lit(BROKEN["gbk"]), F.col("doc_id").cast("string"))).otherwise(F.col("lang"))
    return documents.select("doc_id", text.repaired(broken).alias("label"))


@query("i4_lines_of_hits", "pts", "hits", sql="SELECT h.dataset_name, max(h.similarity) AS similarity, p.n AS points FROM hits h JOIN (SELECT dataset_name, count(*) AS n FROM pts GROUP BY 1 HAVING count(*) >= 2) p ON p.dataset_name = h.dataset_name GROUP BY 1, 3")
def i4(pts, hits):
    best = hits.groupBy("dataset_name").agg(F.max("similarity").alias("similarity"))
    return T.build(pts).join(best, "dataset_name").select("dataset_name", "similarity", F.col("point_count").alias("points"))


@query("i5_grown_boxes", "boxes", sql="SELECT scene_token, round((xmax - xmin + 20 / 111320.0::DOUBLE) * 111320, 3) AS metres FROM boxes")
def i5(boxes):
    grow = 10 / METRES_PER_DEGREE
    grown = boxes.withColumns({"xmin": F.col("xmin") - grow, "xmax": F.col("xmax") + grow})
    return grown.select("scene_token", F.round((F.col("xmax") - F.col("xmin")) * METRES_PER_DEGREE, 3).alias("metres"))


@query("j3_image_formats", "pages", sql="SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'png' WHEN 1 THEN 'gif' ELSE 'jpeg' END AS format FROM pages")
def j3(pages):
    head = F.when(F.col("page_id") % 3 == 0, F.unhex(F.lit("89504E470D0A1A0A"))).when(F.col("page_id") % 3 == 1, F.encode(F.lit("GIF89a"), "UTF-8")).otherwise(F.unhex(F.lit("FFD8FF")))
    return pages.select("page_id", text.image_format(F.concat(head, F.encode("html", "UTF-8"))).alias("format"))


@query("j11_polylines", "pts", sql="SELECT dataset_name, count(*) AS points, round(min(lon), 6) AS west FROM pts GROUP BY 1")
def j11(pts):
    pair = F.concat_ws(",", F.col("lon").cast("string"), F.col("lat").cast("string"))
    line = pts.groupBy("dataset_name").agg(M.polyline(F.array_join(F.collect_list(pair), ";")).alias("line"))
    return line.select("dataset_name", F.size("line").cast("long").alias("points"), F.round(F.array_min(F.transform("line", lambda p: p["lon"])), 6).alias("west"))


@query("f8_straight_distances", "pts", sql=f"WITH c AS (SELECT dataset_name, arg_min(lon, seq) AS x1, arg_min(lat, seq) AS y1, arg_max(lon, seq) AS x2, arg_max(lat, seq) AS y2 FROM pts GROUP BY 1) SELECT dataset_name, round({HAV.format(x1='x1', y1='y1', x2='x2', y2='y2')}, 3) AS straight FROM c")
def f8(pts):
    return chords(pts).select("dataset_name", F.round(haversine(*[F.col(c) for c in ("x1", "y1", "x2", "y2")]), 3).alias("straight"))
