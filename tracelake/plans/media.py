"""Queries on quality checks, retrieval, images and routes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelake.functions import text
from tracelake.operators import media as M
from tracelake.operators import quality_check as H
from tracelake.operators import retrieval as I
from tracelake.plans.registry import query

RECORDS = """SELECT doc_id AS autoscene_id, CASE WHEN doc_id % 4 = 0 THEN 'good' WHEN doc_id % 4 = 1 THEN '[''b '', ''a'', ''b'']' WHEN doc_id % 4 = 2 THEN ' nan ' ELSE lang END AS result,
  CASE WHEN doc_id % 3 = 0 THEN 'None' ELSE source END AS other_scenario, concat('[[', doc_id % 5, ', ', doc_id % 5 + 2.5, '], [9, 3], [20, 31]]') AS description, concat('traj_', doc_id % 200) AS dataset_name FROM documents"""


def records(documents):
    i = F.col("doc_id")
    low = (i % 5).cast("string")
    return documents.select(
        i.alias("autoscene_id"), F.when(i % 4 == 0, "good").when(i % 4 == 1, "['b ', 'a', 'b']").when(i % 4 == 2, " nan ").otherwise(F.col("lang")).alias("result"),
        F.when(i % 3 == 0, "None").otherwise(F.col("source")).alias("other_scenario"),
        F.concat(F.lit("[["), low, F.lit(", "), (i % 5 + 2.5).cast("string"), F.lit("], [9, 3], [20, 31]]")).alias("description"), F.concat(F.lit("traj_"), i % 200).alias("dataset_name"),
    )


CLEAN = f"r AS ({RECORDS}), k AS (SELECT autoscene_id, dataset_name, description, CASE WHEN trim(result) IN ('nan', 'None', '') THEN NULL ELSE trim(result) END AS result, CASE WHEN trim(other_scenario) IN ('nan', 'None', '') THEN NULL ELSE trim(other_scenario) END AS other_scenario FROM r)"


@query("h2_cleaned", "documents", sql=f"WITH {CLEAN} SELECT autoscene_id, result, other_scenario FROM k")
def h2(documents):
    return H.cleaned(records(documents)).select("autoscene_id", "result", "other_scenario")


@query("h3_worth_cutting", "documents", sql=f"WITH {CLEAN} SELECT autoscene_id FROM k WHERE (result IS NOT NULL OR other_scenario IS NOT NULL) AND coalesce(result NOT IN ('good', '[''good'']'), true)")
def h3(documents):
    return H.worth_cutting(H.cleaned(records(documents))).select("autoscene_id")


@query("h6_merged_labels", "documents", sql=f"""WITH {CLEAN}, a AS (SELECT autoscene_id, unnest(list_concat(CASE WHEN result LIKE '[%' THEN ['b', 'a', 'b'] WHEN result IS NOT NULL THEN [result] ELSE [] END, CASE WHEN other_scenario IS NOT NULL THEN [other_scenario] ELSE [] END)) AS x FROM k)
SELECT k.autoscene_id, coalesce(m.labels, '') AS labels FROM k LEFT JOIN (SELECT autoscene_id, array_to_string(list_sort(list(DISTINCT x)), ',') AS labels FROM a GROUP BY 1) m ON m.autoscene_id = k.autoscene_id""")
def h6(documents):
    found = H.cleaned(records(documents))
    return found.select("autoscene_id", F.array_join(text.merged_labels(H.labels(F.col("result")), H.labels(F.col("other_scenario"))), ",").alias("labels"))


@query("h7_units", "pts", sql="SELECT dataset_name, CASE WHEN d < 1000 THEN 1.0::DOUBLE WHEN d < 100000 THEN 1000 WHEN d < 100000000 THEN 1000000 ELSE 1000000000 END AS unit FROM (SELECT dataset_name, (max(ts) - min(ts)) * CASE WHEN dataset_name LIKE '%1' THEN 1000 ELSE 1 END AS d FROM pts GROUP BY 1)")
def h7(pts):
    d = (F.max("ts") - F.min("ts")) * F.when(F.first("dataset_name").endswith("1"), 1000).otherwise(1)
    return pts.groupBy("dataset_name").agg(d.alias("d")).select("dataset_name", H.unit_of(F.col("d")).alias("unit"))


@query("h8_cut_by_ranges", "pts", "documents", sql=f"""WITH r AS ({RECORDS}), v AS (SELECT dataset_name, autoscene_id * 10 + k AS range_no, CASE k WHEN 0 THEN CAST(autoscene_id % 5 AS DOUBLE) ELSE 20 END AS lo, CASE k WHEN 0 THEN CAST(autoscene_id % 5 + 2.5 AS DOUBLE) ELSE 31 END AS hi FROM r, range(0, 2) AS x(k)),
t AS (SELECT dataset_name, seq, ts - min(ts) OVER (PARTITION BY dataset_name) AS a, max(ts) OVER (PARTITION BY dataset_name) - min(ts) OVER (PARTITION BY dataset_name) AS d FROM pts),
m AS (SELECT t.*, v.range_no, greatest(0.5, ceil(greatest(v.lo - a, a - v.hi, 0) / 0.5) * 0.5) AS need FROM t JOIN v USING (dataset_name) WHERE v.hi >= 0 AND v.lo <= d),
n AS (SELECT *, row_number() OVER (PARTITION BY dataset_name, range_no ORDER BY need, seq) AS nth FROM m WHERE need <= least(5, 0.1 * d)), k AS (SELECT dataset_name, range_no, need AS tolerance FROM n WHERE nth = 2)
SELECT dataset_name, range_no, seq, CAST(tolerance AS DOUBLE) AS tolerance FROM n JOIN k USING (dataset_name, range_no) WHERE need <= tolerance""")
def h8(pts, documents):
    ranges = H.ranges_of(records(documents), "autoscene_id").withColumn("range_no", F.col("autoscene_id") * 10 + F.col("range_no")).drop("autoscene_id")
    return H.cut_by_ranges(pts, ranges).select("dataset_name", F.col("range_no").cast("long").alias("range_no"), "seq", "tolerance")


@query("h9_segments_or_whole", "pts", "documents", sql=f"WITH r AS ({RECORDS}) SELECT dataset_name, count(*) AS points FROM pts WHERE dataset_name NOT IN (SELECT dataset_name FROM r WHERE result = 'good') GROUP BY 1")
def h9(pts, documents):
    cut = H.cleaned(records(documents)).where("result = 'good'").select("dataset_name")
    return pts.join(cut, "dataset_name", "left_anti").groupBy("dataset_name").agg(F.count("*").alias("points"))


@query("h5_event_numbers", "events", sql="SELECT event_id, CAST(event_id AS INT) AS n FROM events")
def h5(events):
    return events.select("event_id", H.whole_number(F.concat(F.col("event_id").cast("string"), F.lit(".0"))).alias("n"))


@query("i1_nearest_vectors", "embeddings", sql="""
WITH q AS (SELECT label AS query_id, CAST(arg_min(embedding, vec_id) AS DOUBLE[]) AS q FROM embeddings GROUP BY 1), s AS (SELECT query_id, vec_id, list_cosine_similarity(q, CAST(embedding AS DOUBLE[])) AS c FROM q, embeddings)
SELECT query_id, vec_id, round(c, 6) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY c DESC, vec_id) AS r FROM s) WHERE r <= 10""")
def i1(embeddings):
    queries = embeddings.groupBy(F.col("label").alias("query_id")).agg(F.min_by("embedding", "vec_id").cast("array<double>").alias("q"))  # one for each of few labels
    return I.nearest(embeddings, queries, 10).select("query_id", "vec_id", F.round("similarity", 6).alias("similarity"))


@query("i1_filtered_retrieval", "embeddings", "hits", sql="""
WITH q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id % 10 = 3), v AS (SELECT e.vec_id, e.embedding FROM embeddings e JOIN hits h USING (vec_id) WHERE timestamp_ms >= 1704067200000 + 600000 AND timestamp_ms <= 1704067200000 + 12000000 AND dataset_name IN ('traj_1', 'traj_2', 'traj_3', 'traj_5', 'traj_8', 'traj_13')),
s AS (SELECT query_id, vec_id, list_cosine_similarity(q, CAST(embedding AS DOUBLE[])) AS c FROM q, v) SELECT query_id, vec_id, CAST(r AS INT) AS nth, round(c, 6) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY c DESC, vec_id) AS r FROM s) WHERE r <= 5""")
def i1_filtered(embeddings, hits):
    vectors = embeddings.join(hits.select("vec_id", "timestamp_ms", "dataset_name"), "vec_id")
    queries = embeddings.where("vec_id % 10 = 3").select(F.col("vec_id").alias("query_id"), F.col("embedding").cast("array<double>").alias("q"))
    begin, names = 1704067200000, [f"traj_{n}" for n in (1, 2, 3, 5, 8, 13)]
    found = I.nearest(vectors, queries, 5, start=begin + 600_000, stop=begin + 12_000_000, datasets=names, quota=I.Quota())
    return found.select("query_id", "vec_id", "nth", F.round("similarity", 6).alias("similarity"))


@query("i2_hits_by_dataset", "hits", sql="SELECT dataset_name, count(*) AS hits, round(avg(similarity), 6) AS mean, max(similarity) AS most FROM hits GROUP BY 1")
def i2(hits):
    return hits.groupBy("dataset_name").agg(F.count("*").alias("hits"), F.round(F.avg("similarity"), 6).alias("mean"), F.max("similarity").alias("most"))


@query("i3_time_windows", "hits", sql="SELECT dataset_name, count(*) AS hits, min(timestamp_ms) - 43200000 AS start_ms, max(timestamp_ms) + 43200000 AS end_ms FROM hits GROUP BY 1")
def i3(hits):
    return I.windows(hits)


@query("i9_similarity_summary", "hits", sql="SELECT count(*) AS hits, min(similarity) AS least, max(similarity) AS most, round(avg(similarity), 6) AS mean, median(similarity) AS median FROM hits")
def i9(hits):
    return I.summary(hits)


@query("i9_similarity_histogram", "hits", sql="SELECT CAST(least(floor(similarity * 10), 9) AS INT) AS bin, count(*) AS hits FROM hits GROUP BY 1")
def i9_bins(hits):
    return I.histogram(hits)


@query("i10_workflow_ratios", "hits", sql="SELECT count(*) AS hits, count(DISTINCT dataset_name) AS datasets, round(1 - count(DISTINCT dataset_name) / CAST(count(*) AS DOUBLE), 4) AS reduction, max(timestamp_ms) - min(timestamp_ms) AS span_ms FROM hits")
def i10(hits):
    n, d = F.count("*"), F.countDistinct("dataset_name")
    return hits.agg(n.alias("hits"), d.alias("datasets"), F.round(1 - d / n, 4).alias("reduction"), (F.max("timestamp_ms") - F.min("timestamp_ms")).alias("span_ms"))


@query("i12_cameras", "embeddings", sql="SELECT vec_id, CASE WHEN label % 3 = 0 THEN 'camera_1' ELSE concat('camera_', label) END AS camera FROM embeddings")
def i12(embeddings):
    name = F.when(F.col("label") % 3 == 0, "other").otherwise(F.concat(F.lit("x_camera_encoded_"), "label"))
    return embeddings.select("vec_id", text.camera(name).alias("camera"))


@query("j1_page_paths", "pages", "documents", sql="SELECT page_id, url FROM pages WHERE page_id IN (SELECT doc_id FROM documents WHERE lang = 'fr')")
def j1(pages, documents):
    return pages.join(documents.where("lang = 'fr'").select(F.col("doc_id").alias("page_id")), "page_id", "left_semi").select("page_id", "url")


@query("j2_first_frames", "pages", sql="SELECT CAST(page_id % 20 AS VARCHAR) AS scene_id, page_id AS timestamp, CAST(row_number() OVER (PARTITION BY page_id % 20 ORDER BY page_id) - 1 AS INT) AS frame_index, 'unknown' AS image_format FROM pages QUALIFY row_number() OVER (PARTITION BY page_id % 20 ORDER BY page_id) <= 3")
def j2(pages):
    rows = pages.select((F.col("page_id") % 20).cast("string").alias("scene_id"), F.col("page_id").alias("timestamp"), F.encode("html", "UTF-8").alias("image"))
    return M.frames(rows, most=3).select("scene_id", "timestamp", "frame_index", "image_format")


@query("j5_report_sizes", "pages", sql="SELECT CAST(page_id % 20 AS VARCHAR) AS scene_id, CAST(sum(length(to_base64(encode(html)))) AS BIGINT) AS characters FROM (SELECT *, row_number() OVER (PARTITION BY page_id % 20 ORDER BY page_id) AS r FROM pages) WHERE r <= 2 GROUP BY 1")
def j5(pages):
    rows = pages.select((F.col("page_id") % 20).cast("string").alias("scene_id"), F.col("page_id").alias("timestamp"), F.encode("html", "UTF-8").alias("image"))
    html = F.regexp_replace(F.regexp_replace("html", r"<h2>[^<]*</h2>\n|<img alt=\"\" src=\"data:image/unknown;base64,|\"/>|\n", ""), r"\r", "")
    return M.report(M.frames(rows, most=2)).select("scene_id", F.length(html).cast("long").alias("characters"))


@query("j9_route_ids", "pages", sql="SELECT page_id, CASE WHEN page_id % 2 = 0 THEN CAST(page_id AS VARCHAR) END AS route_id FROM pages")
def j9(pages):
    host = F.when(F.col("page_id") % 2 == 0, "https://www.amap.com/route/").otherwise("https://example.com/route/")
    return pages.select("page_id", M.route_id(F.concat(host, "page_id", F.lit("/"))).alias("route_id"))


@query("j10_route_ends", "pages", sql="SELECT page_id, 116 + page_id / 1000::DOUBLE AS lon, CAST(39.5 AS DOUBLE) AS lat FROM pages")
def j10(pages):
    url = F.concat(F.lit("https://amap.com/dir?src="), (116 + F.col("page_id") / 1000).cast("string"), F.lit(",39.5&dest=1,2"))
    return pages.select("page_id", M.coordinates(url, "src").alias("c")).select("page_id", "c.lon", "c.lat")


@query("j12_routes", "pts", sql="SELECT dataset_name AS route, count(*) AS path_points, round(sum(twist_linear), 3) AS distance FROM pts WHERE lon > 0 GROUP BY 1")
def j12(pts):
    step = pts.select(F.col("dataset_name").alias("route"), "seq", F.concat_ws(",", F.col("lon").cast("string"), F.col("lat").cast("string")).alias("polyline"), F.col("twist_linear").alias("distance"))
    return M.assembled(step, "route", "seq").select("route", F.size("path").cast("long").alias("path_points"), F.round("distance", 3).alias("distance"))


@query("j13_routes_of_source", "pages", sql="SELECT page_id, url FROM pages WHERE url LIKE '%1%'")
def j13(pages):
    return pages.where("url like '%1%'").select("page_id", "url")


@query("j17_shown_times", "hits", sql="SELECT vec_id, strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%d %H:%M:%S') AS shown FROM hits")
def j17(hits):
    t = F.when(F.col("vec_id") % 2 == 0, F.col("timestamp_ms") * 1000).otherwise(F.col("timestamp_ms"))
    return hits.select("vec_id", M.shown_time(t).alias("shown"))


@query("i8_events_json", "events", sql="SELECT event_type, count(*) AS n, count(json_extract_string(props, '$.k')) AS with_k FROM events GROUP BY 1")
def i8(events):
    return events.groupBy("event_type").agg(F.count("*").alias("n"), F.count(F.get_json_object("props", "$.k")).alias("with_k"))
