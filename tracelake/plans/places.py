"""Queries on datasets, boxes, spatial joins and density."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tracelake.functions import text
from tracelake.functions.geo import iou
from tracelake.functions.graph import materialize
from tracelake.operators import boxes as B
from tracelake.operators import datasets as D
from tracelake.operators import density as E
from tracelake.plans.registry import query

JOIN = "boxes b JOIN crossings c ON b.xmin <= c.xmax AND b.xmax >= c.xmin AND b.ymin <= c.ymax AND b.ymax >= c.ymin"
LINE = "CASE WHEN doc_id % 11 = 0 THEN 'bad line' WHEN doc_id % 13 = 0 THEN '' ELSE concat(obs_path, '@duplicate', duplication_factor) END"


@query("a1_index_lines", "scenes", sql=f"""
WITH l AS (SELECT {LINE} AS value FROM scenes)
SELECT split_part(value, '@', 1) AS path, CAST(replace(split_part(value, '@', 2), 'duplicate', '') AS INT) AS factor, regexp_extract(value, '/god/([^/]+)/train_god_', 1) AS subdataset_name FROM l WHERE value LIKE '%@%'""")
def a1(scenes):
    return D.parse_index(scenes.selectExpr(f"{LINE} AS value"))


@query("a4_duplicated_scenes", "scenes", sql="SELECT scene_id, unnest(range(0, duplication_factor)) AS duplicate_index FROM scenes")
def a4(scenes):
    return D.duplicated(scenes).select("scene_id", F.col("duplicate_index").cast("long").alias("duplicate_index"))


@query("a8_subdataset_names", "scenes", sql="""
WITH p AS (SELECT scene_id, obs_path AS path FROM scenes UNION ALL SELECT scene_id, concat('obs://x/god/a/', 'GOD_E2E_', subdataset_name, '/b/c.shrink') FROM scenes UNION ALL SELECT scene_id, concat('obs://x/', subdataset_name, '/c.shrink') FROM scenes)
SELECT scene_id, path, coalesce(nullif(regexp_extract(path, '/god/([^/]+)/train_god_', 1), ''), nullif(regexp_extract(path, '/god/(?:[^/]*/)*?([^/]*GOD_E2E[^/]*)', 1), ''), regexp_extract(path, '([^/]+)/[^/]*$', 1)) AS subdataset_name FROM p""")
def a8(scenes):
    paths = [F.col("obs_path"), F.concat(F.lit("obs://x/god/a/GOD_E2E_"), "subdataset_name", F.lit("/b/c.shrink")), F.concat(F.lit("obs://x/"), "subdataset_name", F.lit("/c.shrink"))]
    rows = scenes.select("scene_id", F.explode(F.array(*paths)).alias("path"))
    return rows.withColumn("subdataset_name", text.subdataset_name(F.col("path")))


@query("a9_defect_lines", "scenes", sql="""
SELECT concat('d', doc_id) AS data_name, lang AS lang_attribute, 'true' AS flagged FROM scenes""")
def a9(scenes):
    lines = scenes.select(F.concat(F.lit("https://host/play?x=1&dataName=d"), "doc_id", F.lit("&y=2|lang="), "lang", F.lit("|flagged")).alias("value"))
    return D.defect_lines(lines).select("data_name", F.col("attributes")["lang"].alias("lang_attribute"), F.col("attributes")["flagged"].alias("flagged"))


@query("a10_two_hop_lookup", "orders", "customer", "nation", sql="""
SELECT o.o_orderkey, n.n_name FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def a10(orders, customer, nation):
    first = customer.selectExpr("c_custkey AS name", "c_nationkey AS link")
    second = nation.selectExpr("n_nationkey AS link", "n_name")
    return D.two_hops(orders.selectExpr("o_orderkey", "o_custkey AS name"), first, second, "name", "link", "n_name").drop("name")


@query("a11_assembled_subdatasets", "scenes", sql="""
SELECT subdataset_name, duplication_factor, count(*) AS scene_count, count(*) * duplication_factor AS total_count, array_to_string(list_sort(list(scene_id)), ',') AS scene_ids FROM scenes GROUP BY 1, 2""")
def a11(scenes):
    return D.assemble(scenes).withColumn("scene_ids", F.array_join("scene_ids", ","))


@query("a14_filtered_scenes", "scenes", sql="SELECT scene_id, lang, subdataset_name FROM scenes WHERE lang = 'de' AND duplication_factor = 1")
def a14(scenes):
    return D.matching(scenes, lang="de", duplication_factor=1, unknown="x").select("scene_id", "lang", "subdataset_name")


@query("a15_scene_ids", "scenes", sql="SELECT scene_id FROM scenes WHERE subdataset_name = 'src1'")
def a15(scenes):
    return D.matching(scenes, subdataset_name="src1").select("scene_id")


@query("a17_export_counts", "scenes", sql="SELECT subdataset_name, CAST(sum(duplication_factor) AS BIGINT) AS rows_out, CAST(max(duplication_factor - 1) AS BIGINT) AS last_index FROM scenes GROUP BY 1")
def a17(scenes):
    return D.duplicated(scenes).groupBy("subdataset_name").agg(F.count("*").alias("rows_out"), F.max("duplicate_index").cast("long").alias("last_index"))


@query("a18_dataset_stats", "scenes", sql="SELECT subdataset_name, count(*) AS unique_scenes, min(duplication_factor) AS min_factor, CAST(sum(duplication_factor) AS BIGINT) AS total_scenes FROM scenes GROUP BY 1")
def a18(scenes):
    return D.stats(scenes)


@query("a19_distinct_ids", "events", sql="SELECT DISTINCT concat('scene_', user_id) AS scene_id FROM events")
def a19(events):
    return events.select(F.concat(F.lit("scene_"), "user_id").alias("scene_id")).distinct()


@query("b1_metadata_of_tokens", "scenes", "events", sql="SELECT scene_id, lang FROM scenes WHERE scene_id IN (SELECT concat('scene_', user_id) FROM events)")
def b1(scenes, events):
    return scenes.join(events.select(F.concat(F.lit("scene_"), "user_id").alias("scene_id")), "scene_id", "left_semi").select("scene_id", "lang")


@query("b2_extents", "pts", sql="SELECT dataset_name, min(lon) AS xmin, max(lon) AS xmax, min(lat) AS ymin, max(lat) AS ymax, bool_and(workstage = 2) AS all_good FROM pts GROUP BY 1")
def b2(pts):
    return B.extents(pts, "dataset_name")


@query("b3_points_or_boxes", "pts", sql="""
WITH e AS (SELECT dataset_name, seq % 50 AS part, min(lon) AS xmin, max(lon) AS xmax, min(lat) AS ymin, max(lat) AS ymax, bool_and(workstage = 2) AS all_good FROM pts GROUP BY 1, 2)
SELECT dataset_name, part, all_good, CASE WHEN p THEN (xmin + xmax) / 2 ELSE xmin END AS xmin, CASE WHEN p THEN (xmin + xmax) / 2 ELSE xmax END AS xmax, CASE WHEN p THEN (ymin + ymax) / 2 ELSE ymin END AS ymin,
  CASE WHEN p THEN (ymin + ymax) / 2 ELSE ymax END AS ymax, CASE WHEN p THEN 'POINT' ELSE 'POLYGON' END AS shape FROM (SELECT *, xmin = xmax OR ymin = ymax AS p FROM e)""")
def b3(pts):
    return B.shaped(B.extents(pts.withColumn("part", F.col("seq") % 50), "dataset_name", "part"))


@query("b5_box_rows", "pts", "scenes", sql="""
SELECT s.scene_id, s.lang, p.dataset_name, min(p.lon) AS xmin, max(p.lat) AS ymax, bool_and(p.workstage = 2) AS all_good FROM scenes s JOIN pts p ON p.scene_token = s.scene_id GROUP BY 1, 2, 3""")
def b5(pts, scenes):
    found = B.extents(pts, "dataset_name", "scene_token")
    return scenes.join(found, scenes["scene_id"] == found["scene_token"]).select("scene_id", "lang", "dataset_name", "xmin", "ymax", "all_good")


@query("b7_table_names", "scenes", sql="""
WITH n AS (SELECT DISTINCT subdataset_name, concat('GOD_E2E_', subdataset_name, '_Lane-Change_sub_ddi_12') AS raw FROM scenes), m AS (
  SELECT subdataset_name, raw, regexp_replace(regexp_replace(raw, '^GOD_E2E_', ''), '_sub_ddi_.*$', '') AS name FROM n)
SELECT subdataset_name, name, substr(concat('clips_bbox_', regexp_replace(substr(lower(regexp_replace(name, '[^A-Za-z0-9_]', '_', 'g')), 1, 38), '_+$', '')), 1, 50) AS table_name FROM m""")
def b7(scenes):
    raw = F.concat(F.lit("GOD_E2E_"), "subdataset_name", F.lit("_Lane-Change_sub_ddi_12"))
    return scenes.select("subdataset_name").distinct().select("subdataset_name", text.normal_name(raw).alias("name"), text.table_name(raw).alias("table_name"))


@query("b8_field_types", "documents", sql="""
WITH v AS (SELECT 'doc_id' AS field, CAST(doc_id AS VARCHAR) AS value FROM documents UNION ALL SELECT 'lang', lang FROM documents UNION ALL SELECT 'flag', CASE WHEN doc_id % 2 = 0 THEN 'true' ELSE 'False' END FROM documents
  UNION ALL SELECT 'mixed', CASE WHEN doc_id % 3 = 0 THEN 'true' WHEN doc_id % 3 = 1 THEN '12' ELSE '1.5' END FROM documents), t AS (
  SELECT field, CASE WHEN lower(value) IN ('true', 'false') THEN 1 WHEN regexp_full_match(value, '[+-]?[0-9]+') THEN 2 WHEN regexp_full_match(value, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)') THEN 3 ELSE 4 END AS k FROM v)
SELECT field, ['boolean', 'integer', 'numeric', 'text'][max(k)] AS type FROM t GROUP BY 1""")
def b8(documents):
    i = F.col("doc_id")
    fields = {"doc_id": i.cast("string"), "lang": F.col("lang"), "flag": F.when(i % 2 == 0, "true").otherwise("False"), "mixed": F.when(i % 3 == 0, "true").when(i % 3 == 1, "12").otherwise("1.5")}
    rows = documents.select(F.explode(F.array(*[F.struct(F.lit(k).alias("field"), v.alias("value")) for k, v in fields.items()])).alias("x")).select("x.*")
    return rows.groupBy("field").agg(text.merged_type(text.field_type(F.col("value"))).alias("type"))


@query("b9_unified_view", "boxes", sql="SELECT row_number() OVER (ORDER BY subdataset_name, scene_token) AS qgis_id, subdataset_name AS source_table, scene_token, all_good FROM boxes")
def b9(boxes):
    # numbered within each table, above the (few) tables before it: no sort of all rows in one place
    sizes = boxes.groupBy("subdataset_name").agg(F.count("*").alias("n"))
    earlier = F.coalesce(F.sum("n").over(Window.orderBy("subdataset_name").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = F.row_number().over(Window.partitionBy("subdataset_name").orderBy("scene_token"))
    numbered = boxes.join(sizes.select("subdataset_name", earlier.alias("earlier")), "subdataset_name").withColumn("qgis_id", F.col("earlier") + own)
    return numbered.select("qgis_id", F.col("subdataset_name").alias("source_table"), "scene_token", "all_good")


@query("b11_remaining", "orders", "lineitem", sql="SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey IS NOT NULL)")
def b11(orders, lineitem):
    done = lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return D.remaining(orders.select("o_orderkey"), done, "o_orderkey")


@query("b12_retry", "events", sql="SELECT DISTINCT user_id FROM events WHERE event_type = 'error' AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 90)")
def b12(events):
    return D.retryable(events.where("event_type = 'error'"), events.where("event_type = 'purchase' and value > 90").select("user_id"), "user_id")


@query("b13_failures_by_step", "events", sql="SELECT event_type AS step, count(*) AS failures, count(DISTINCT user_id) AS scenes FROM events GROUP BY 1")
def b13(events):
    return events.groupBy(F.col("event_type").alias("step")).agg(F.count("*").alias("failures"), F.countDistinct("user_id").alias("scenes"))


@query("b14_last_success", "events", sql="SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def b14(events):
    return D.latest(events, ["user_id"], F.desc("ts"), F.desc("event_id")).select("user_id", "event_id", "event_type")


@query("b15_unique_insert", "events", sql="SELECT DISTINCT user_id, event_type FROM events")
def b15(events):
    return events.select("user_id", "event_type").dropDuplicates()


@query("b16_partition_filter", "scenes", sql="SELECT DISTINCT subdataset_name FROM scenes WHERE regexp_matches(subdataset_name, '^src1') AND subdataset_name NOT IN (SELECT subdataset_name FROM scenes WHERE n_chars > 20000)")
def b16(scenes):
    bad = scenes.where("n_chars > 20000").select("subdataset_name")
    return scenes.where(F.col("subdataset_name").rlike("^src1")).select("subdataset_name").distinct().join(bad, "subdataset_name", "left_anti")


@query("c1_hits_per_box", "boxes", "crossings", sql=f"SELECT b.scene_token, coalesce(n, 0) AS hits FROM boxes b LEFT JOIN (SELECT b.scene_token, count(*) AS n FROM {JOIN} GROUP BY 1) h ON h.scene_token = b.scene_token")
def c1(boxes, crossings):
    return B.hit_counts(boxes, crossings, "scene_token")


@query("c2_pairs", "boxes", "crossings", sql=f"SELECT b.scene_token, b.city_id, c.intersection_id, c.intersectiontype FROM {JOIN}")
def c2(boxes, crossings):
    return B.pairs(boxes, crossings).select("scene_token", "city_id", "intersection_id", "intersectiontype")


@query("c3_boxes_of_city", "boxes", sql="SELECT scene_token, city_id FROM boxes WHERE city_id = 'A1' ORDER BY scene_token LIMIT 10")
def c3(boxes):
    return boxes.where("city_id = 'A1'").orderBy("scene_token").limit(10).select("scene_token", "city_id")


@query("c4_analysis_by_type", "boxes", "crossings", sql=f"SELECT b.city_id, c.intersectiontype, count(*) AS intersection_count, count(DISTINCT c.intersection_id) AS unique_intersections FROM {JOIN} GROUP BY 1, 2")
def c4(boxes, crossings):
    return B.analysed(boxes, crossings, ("city_id", "intersectiontype"))


@query("c5_analysis_overall", "boxes", "crossings", sql=f"SELECT count(*) AS intersection_count, count(DISTINCT c.intersection_id) AS unique_intersections, count(DISTINCT b.scene_token) AS unique_scenes FROM {JOIN}")
def c5(boxes, crossings):
    return B.analysed(boxes, crossings)


@query("c6_details", "boxes", "crossings", sql=f"SELECT b.scene_token, c.intersection_id, c.intersectionsubtype FROM {JOIN}")
def c6(boxes, crossings):
    return B.pairs(boxes, crossings).select("scene_token", "intersection_id", "intersectionsubtype")


@query("c7_dense_scenes", "boxes", "crossings", sql=f"SELECT b.scene_token, count(*) AS n, count(DISTINCT c.intersectiontype) AS kinds FROM {JOIN} GROUP BY 1 ORDER BY n DESC, kinds DESC, b.scene_token LIMIT 20")
def c7(boxes, crossings):
    kinds = crossings.groupBy(*B.BOX, "intersectiontype").agg(F.count("*").alias("n"))
    met = B.side(B.met_classes(boxes, crossings), "r_", *[F.col(f"l_{c}") for c in B.BOX]).join(kinds, B.BOX).drop(*B.BOX)
    met = met.groupBy(*[F.col(f"l_{c}").alias(c) for c in B.BOX], "intersectiontype").agg(F.sum("n").alias("n"))
    return boxes.select("scene_token", *B.BOX).join(met, B.BOX).groupBy("scene_token").agg(F.sum("n").alias("n"), F.countDistinct("intersectiontype").alias("kinds")).orderBy(F.desc("n"), F.desc("kinds"), "scene_token").limit(20)


def case(column, names):
    return f"CASE {column} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in names.items()) + " ELSE 'Unknown' END"


@query("c8_type_summary", "crossings", sql=f"SELECT intersectiontype, intersectionsubtype, {case('intersectiontype', B.TYPES)} AS type_name, {case('intersectionsubtype', B.SUBTYPES)} AS subtype_name, count(*) AS n FROM crossings GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 50")
def c8(crossings):
    n = crossings.groupBy("intersectiontype", "intersectionsubtype").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "intersectiontype", "intersectionsubtype").limit(50)
    return n.withColumns({"type_name": B.label(F.col("intersectiontype"), B.TYPES), "subtype_name": B.label(F.col("intersectionsubtype"), B.SUBTYPES)})


@query("c9_cities", "boxes", sql="SELECT city_id, count(*) AS n FROM boxes GROUP BY 1")
def c9(boxes):
    return boxes.groupBy("city_id").agg(F.count("*").alias("n"))


@query("c11_named_results", "boxes", "crossings", sql=f"""
SELECT 'intersectiontype' AS group_dimension, CAST(c.intersectiontype AS VARCHAR) AS group_value, {case('c.intersectiontype', B.TYPES)} AS group_name, count(*) AS intersection_count, '{{"city":"all","limit":10}}' AS analysis_params FROM {JOIN} GROUP BY c.intersectiontype""")
def c11(boxes, crossings):
    return B.named_result(B.analysed(boxes, crossings, ("intersectiontype",)), "intersectiontype", {"city": "all", "limit": 10})


@query("c12_group_envelope", "boxes", "crossings", sql=f"SELECT c.intersectiontype, min(c.intersection_id) AS first_id, arg_min(c.xmin, c.intersection_id) AS xmin, arg_min(c.ymin, c.intersection_id) AS ymin FROM {JOIN} GROUP BY 1")
def c12(boxes, crossings):
    met = crossings.join(B.side(B.met_classes(boxes, crossings), "r_").distinct(), B.BOX, "left_semi")
    return met.groupBy("intersectiontype").agg(F.min("intersection_id").alias("first_id"), F.min_by("xmin", "intersection_id").alias("xmin"), F.min_by("ymin", "intersection_id").alias("ymin"))


@query("c13_sampled_details", "boxes", "crossings", sql=f"SELECT scene_token, intersection_id FROM (SELECT b.scene_token, c.intersection_id FROM {JOIN}) ORDER BY md5(concat(scene_token, ':', intersection_id)), 1, 2 LIMIT 50")
def c13(boxes, crossings):
    return B.pairs(boxes, crossings).orderBy(F.md5(F.concat_ws(":", "scene_token", "intersection_id").cast("binary")), "scene_token", "intersection_id").limit(50).select("scene_token", "intersection_id")


@query("c15_cached_scenes", "boxes", "crossings", sql=f"SELECT count(DISTINCT b.scene_token) AS scenes FROM {JOIN}")
def c15(boxes, crossings):
    met = B.side(B.met_classes(boxes, crossings), "l_").distinct()
    return boxes.join(met, B.BOX, "left_semi").agg(F.countDistinct("scene_token").alias("scenes"))


@query("c16_join_kinds", "boxes", "crossings", sql="""
SELECT 'within' AS how, c.intersection_id, b.scene_token FROM boxes b JOIN crossings c ON b.xmin <= c.xmin AND b.xmax >= c.xmax AND b.ymin <= c.ymin AND b.ymax >= c.ymax
UNION ALL SELECT 'dwithin', c.intersection_id, b.scene_token FROM boxes b JOIN crossings c ON greatest(0, c.xmin - b.xmax, b.xmin - c.xmax) ** 2 + greatest(0, c.ymin - b.ymax, b.ymin - c.ymax) ** 2 <= 0.000145 * 0.000145""")
def c16(boxes, crossings):
    a, b = B.folded(crossings.select(*B.BOX, "intersection_id")), B.folded(boxes.select(*B.BOX, "scene_token"))
    pick = lambda f, how: B.unfolded(f, "l_", "r_").select(F.lit(how).alias("how"), F.col("l_intersection_id").alias("intersection_id"), F.col("r_scene_token").alias("scene_token"))
    return pick(B.box_join(a, b, how="within"), "within").unionByName(pick(B.box_join(a, b, how="dwithin", distance=0.000145), "dwithin"))


@query("c17_hot_crossings", "boxes", "crossings", sql=f"SELECT c.intersection_id, c.intersectiontype, count(*) AS n FROM {JOIN} GROUP BY 1, 2 ORDER BY n DESC, 1 LIMIT 10")
def c17(boxes, crossings):
    n = B.side(B.met_classes(boxes, crossings), "r_", "l_n").groupBy(*B.BOX).agg(F.sum("l_n").alias("n"))
    return crossings.join(n, B.BOX).groupBy("intersection_id", "intersectiontype").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "intersection_id").limit(10)


@query("c18_types", "crossings", sql="SELECT intersectiontype, count(*) AS n FROM crossings WHERE intersectiontype IS NOT NULL GROUP BY 1")
def c18(crossings):
    return crossings.where("intersectiontype is not null").groupBy("intersectiontype").agg(F.count("*").alias("n"))


@query("c19_geometry_kinds", "crossings", sql="SELECT CASE WHEN xmin = xmax OR ymin = ymax THEN 'POINT' ELSE 'POLYGON' END AS shape, count(*) AS n FROM crossings WHERE intersectiontype = 2 GROUP BY 1")
def c19(crossings):
    return B.shaped(crossings.where("intersectiontype = 2")).groupBy("shape").agg(F.count("*").alias("n"))


DENSITY = """c AS (
  SELECT b.*, x.gx, y.gy FROM boxes b, unnest(range(CAST(floor(b.xmin / 0.002) AS BIGINT), CAST(floor(b.xmax / 0.002) AS BIGINT) + 1)) AS x(gx), unnest(range(CAST(floor(b.ymin / 0.002) AS BIGINT), CAST(floor(b.ymax / 0.002) AS BIGINT) + 1)) AS y(gy) WHERE all_good
), d AS (
  SELECT city_id, gx AS grid_x, gy AS grid_y, count(*) AS bbox_count, count(DISTINCT subdataset_name) AS subdataset_count, count(DISTINCT scene_token) AS scene_count, array_to_string(list_sort(list(DISTINCT scene_token)), ',') AS scenes, CAST(count(*) AS DOUBLE) AS total_bbox_area
  FROM c GROUP BY 1, 2, 3 HAVING count(*) >= {least}
), r AS (
  SELECT *, row_number() OVER (PARTITION BY city_id ORDER BY bbox_count DESC, grid_x, grid_y) AS hot_rank, count(*) OVER (PARTITION BY city_id) AS n FROM d
)"""
ALL = "WITH " + DENSITY.format(least=1) + " "
MANY = "WITH " + DENSITY.format(least=5) + " "


@query("e1_city_suggestion", "boxes", sql="""
SELECT city_id, total_count, good_count, round(good_count * 100.0::DOUBLE / total_count, 1) AS good_percent, CASE WHEN good_count > 1000 THEN '< 2分钟' ELSE '< 30秒' END AS estimate, CASE WHEN good_count BETWEEN 1000 AND 20000 AND good_count * 100.0 / total_count > 90 THEN '⭐⭐⭐ 推荐' WHEN good_count BETWEEN 500 AND 50000 AND good_count * 100.0 / total_count > 85 THEN '⭐⭐ 较好' WHEN good_count > 100 THEN '⭐ 可用' ELSE '❌ 不建议' END AS recommendation FROM (SELECT city_id, count(*) AS total_count, count(*) FILTER (all_good) AS good_count FROM boxes GROUP BY 1) WHERE good_count > 0""")
def e1(boxes):
    return E.city_quality(boxes).withColumns({"estimate": E.banded(F.col("good_count")), "recommendation": E.recommended(F.col("good_count"), F.col("total_count"))})


@query("e2_city_extent", "boxes", sql="SELECT city_id, min(xmin) AS xmin, max(xmax) AS xmax, round(max(xmax) - min(xmin), 6) AS width, round(max(ymax) - min(ymin), 6) AS height FROM boxes GROUP BY 1")
def e2(boxes):
    return boxes.groupBy("city_id").agg(F.min("xmin").alias("xmin"), F.max("xmax").alias("xmax"), F.round(F.max("xmax") - F.min("xmin"), 6).alias("width"), F.round(F.max("ymax") - F.min("ymin"), 6).alias("height"))


@query("e4_covered_cells", "boxes", sql=ALL + "SELECT scene_token, gx, gy FROM c")
def e4(boxes):
    return B.cells(boxes.where("all_good"), E.CELL).select("scene_token", "gx", "gy")


@query("e5_density", "boxes", sql=MANY + "SELECT city_id, grid_x, grid_y, bbox_count, subdataset_count, scene_count, scenes, total_bbox_area FROM d")
def e5(boxes):
    return E.density(boxes).withColumn("scenes", F.array_join("involved_scenes", ",")).drop("involved_scenes", "involved_subdatasets")


@query("e6_hotspots", "boxes", sql=ALL + "SELECT city_id, grid_x, grid_y, bbox_count, CAST(hot_rank AS INT) AS hot_rank FROM r WHERE hot_rank <= greatest(1, round(n * 0.05))")
def e6(boxes):
    return E.top_share(E.density(boxes, least=1), 5.0).select("city_id", "grid_x", "grid_y", "bbox_count", "hot_rank")


@query("e7_density_summary", "boxes", sql=ALL + "SELECT city_id, count(*) AS cells, max(bbox_count) AS most, min(bbox_count) AS least, round(avg(bbox_count), 4) AS mean, CAST(median(bbox_count) AS DOUBLE) AS median FROM d GROUP BY 1")
def e7(boxes):
    n = F.col("bbox_count")
    return E.density(boxes, least=1).groupBy("city_id").agg(F.count("*").alias("cells"), F.max(n).alias("most"), F.min(n).alias("least"), F.round(F.avg(n), 4).alias("mean"), F.median(n).alias("median"))


@query("e8_upsert", "boxes", sql=ALL + "SELECT city_id, grid_x, grid_y, bbox_count * CASE WHEN bbox_count >= 5 THEN 10 ELSE 1 END AS bbox_count FROM d")
def e8(boxes):
    keys = ["city_id", "grid_x", "grid_y"]
    old = E.density(boxes, least=1).select(*keys, "bbox_count")
    new = E.density(boxes).select(*keys, (F.col("bbox_count") * 10).alias("bbox_count"))
    return E.upsert(old, new, keys)


@query("e9_city_top", "boxes", sql=ALL + "SELECT concat('{\"city_filter\":\"', city_id, '\"}') AS analysis_params, city_id AS city, bbox_count FROM r WHERE hot_rank = 1")
def e9(boxes):
    top = E.ranked(E.density(boxes, least=1), "city_id").withColumn("analysis_params", F.to_json(F.struct(F.col("city_id").alias("city_filter"))))
    return top.where("hot_rank = 1").select("analysis_params", F.get_json_object("analysis_params", "$.city_filter").alias("city"), "bbox_count")


@query("e10_nth_cell", "boxes", sql=ALL + "SELECT city_id, grid_x, grid_y, bbox_count FROM r WHERE hot_rank = 3")
def e10(boxes):
    return E.ranked(E.density(boxes, least=1), "city_id").where("hot_rank = 3").select("city_id", "grid_x", "grid_y", "bbox_count")


@query("e11_cell_members", "boxes", sql=ALL + "SELECT DISTINCT c.city_id, c.scene_token, c.dataset_name FROM c JOIN r ON r.city_id = c.city_id AND r.grid_x = c.gx AND r.grid_y = c.gy WHERE r.hot_rank = 1")
def e11(boxes):
    top = E.ranked(E.density(boxes, least=1), "city_id").where("hot_rank = 1").select("city_id", F.explode("involved_scenes").alias("scene_token"))
    return top.join(boxes.select("city_id", "scene_token", "dataset_name"), ["city_id", "scene_token"]).distinct()


TOP = "t AS (SELECT * FROM r WHERE hot_rank <= greatest(1, CAST(floor(n * 0.1) AS BIGINT)))"
TOUCH = "b.all_good AND b.city_id = t.city_id AND b.xmin <= (t.grid_x + 1) * 0.002::DOUBLE AND b.xmax >= t.grid_x * 0.002::DOUBLE AND b.ymin <= (t.grid_y + 1) * 0.002::DOUBLE AND b.ymax >= t.grid_y * 0.002::DOUBLE"


@query("e12_hotspot_coverage", "boxes", sql=ALL[:-1] + f", {TOP} SELECT t.city_id, count(*) AS covered_rows, count(DISTINCT b.scene_token) AS covered_scenes FROM t JOIN boxes b ON {TOUCH} GROUP BY 1")
def e12(boxes):
    return E.coverage(E.top_share(E.density(boxes, least=1), 10.0, "int"), boxes)


@query("e13_cities_with_cells", "boxes", sql=ALL + "SELECT city_id, count(DISTINCT scene_token) AS scenes FROM boxes WHERE city_id IN (SELECT city_id FROM d WHERE bbox_count >= 5) GROUP BY 1")
def e13(boxes):
    return boxes.join(E.density(boxes).select("city_id"), "city_id", "left_semi").groupBy("city_id").agg(F.countDistinct("scene_token").alias("scenes"))


@query("e14_redundancy_index", "boxes", sql=ALL[:-1] + f""", {TOP}, h AS (SELECT t.city_id, count(DISTINCT b.scene_token) AS covered FROM t JOIN boxes b ON {TOUCH} GROUP BY 1), s AS (SELECT city_id, count(DISTINCT scene_token) AS scenes FROM boxes WHERE all_good GROUP BY 1),
a AS (SELECT city_id, count(*) AS cells, count(*) FILTER (hot_rank <= greatest(1, CAST(floor(n * 0.1) AS BIGINT))) AS top FROM r GROUP BY 1)
SELECT h.city_id, round(covered * 100.0::DOUBLE / scenes, 2) AS scene_percent, round(top * 100.0::DOUBLE / cells, 2) AS area_percent, round((covered / scenes::DOUBLE) / (top / cells::DOUBLE), 2) AS redundancy FROM h JOIN s ON s.city_id = h.city_id JOIN a ON a.city_id = h.city_id""")
def e14(boxes):
    found = E.density(boxes, least=1)
    top = E.top_share(found, 10.0, "int")
    sizes = found.groupBy("city_id").agg(F.count("*").alias("cells")).join(top.groupBy("city_id").agg(F.count("*").alias("top")), "city_id")
    scenes = boxes.where("all_good").groupBy("city_id").agg(F.countDistinct("scene_token").alias("scenes"))
    joined = E.coverage(top, boxes).join(sizes, "city_id").join(scenes, "city_id")
    a, b = F.col("covered_scenes") / F.col("scenes"), F.col("top") / F.col("cells")
    return joined.select("city_id", F.round(F.col("covered_scenes") * 100.0 / F.col("scenes"), 2).alias("scene_percent"), F.round(F.col("top") * 100.0 / F.col("cells"), 2).alias("area_percent"), F.round(a / b, 2).alias("redundancy"))


SHARE = "CAST(sum(bbox_count) FILTER (hot_rank <= greatest(1, round(n * 10.0::DOUBLE / 100))) AS BIGINT)"


@query("e15_simple_redundancy", "boxes", sql=ALL + f"""SELECT city_id, CAST(sum(bbox_count) AS BIGINT) AS all_boxes, {SHARE} AS top_boxes, count(*) AS cells, count(*) FILTER (hot_rank <= greatest(1, round(n * 10.0::DOUBLE / 100))) AS top_cells,
  round(({SHARE} / CAST(sum(bbox_count) AS DOUBLE)) / (count(*) FILTER (hot_rank <= greatest(1, round(n * 10.0::DOUBLE / 100))) / CAST(count(*) AS DOUBLE)), 2) AS redundancy_index FROM r GROUP BY 1""")
def e15(boxes):
    return E.redundancy(E.density(boxes, least=1), 10.0)


@query("e16_pareto", "boxes", sql=ALL + """SELECT city_id, grid_x, grid_y, CAST(hot_rank AS INT) AS hot_rank, round(sum(bbox_count) OVER (PARTITION BY city_id ORDER BY hot_rank) * 100.0::DOUBLE / sum(bbox_count) OVER (PARTITION BY city_id), 4) AS box_percent,
  round(hot_rank * 100.0::DOUBLE / n, 4) AS cell_percent FROM r""")
def e16(boxes):
    return E.pareto(E.density(boxes, least=1))


@query("e17_city_rollup", "boxes", sql=ALL + "SELECT city_id, count(*) AS cells, CAST(sum(bbox_count) AS BIGINT) AS boxes, max(bbox_count) AS most, round(avg(bbox_count), 4) AS mean FROM d GROUP BY 1")
def e17(boxes):
    n = F.col("bbox_count")
    return E.density(boxes, least=1).groupBy("city_id").agg(F.count("*").alias("cells"), F.sum(n).alias("boxes"), F.max(n).alias("most"), F.round(F.avg(n), 4).alias("mean"))


@query("e18_hotspot_view", "boxes", sql=ALL + """SELECT city_id, grid_x, grid_y, CASE WHEN bbox_count >= 20 THEN 'Very High Density' WHEN bbox_count >= 10 THEN 'High Density' WHEN bbox_count >= 5 THEN 'Medium Density' WHEN bbox_count >= 2 THEN 'Low Density' ELSE 'Single Overlap' END AS density_level, 'Large Area' AS area_level, round(0.7 * bbox_count + 0.3 * log10(1 + 10000 * total_bbox_area), 2) AS hotspot_score, concat('Rank ', hot_rank, ': ', bbox_count, ' overlaps') AS rank_label FROM r""")
def e18(boxes):
    n, area = F.col("bbox_count"), F.col("total_bbox_area")
    label = F.concat(F.lit("Rank "), "hot_rank", F.lit(": "), n, F.lit(" overlaps"))
    return E.ranked(E.density(boxes, least=1), "city_id").select(
        "city_id", "grid_x", "grid_y", E.density_level(n).alias("density_level"), E.area_level(area).alias("area_level"), F.round(E.hotspot_score(n, area), 2).alias("hotspot_score"), label.alias("rank_label")
    )


@query("e19_summary_view", "boxes", sql=ALL + "SELECT city_id, min(bbox_count) AS least, max(bbox_count) AS most, count(*) FILTER (bbox_count >= 5) AS dense, min(grid_x) AS gx0, max(grid_x) + 1 AS gx1 FROM d GROUP BY 1")
def e19(boxes):
    n = F.col("bbox_count")
    return E.density(boxes, least=1).groupBy("city_id").agg(F.min(n).alias("least"), F.max(n).alias("most"), F.count_if(n >= 5).alias("dense"), F.min("grid_x").alias("gx0"), (F.max("grid_x") + 1).alias("gx1"))


@query("e20_detail_view", "boxes", sql=ALL + "SELECT city_id, grid_x, grid_y, round((grid_x + 0.5) * 0.002::DOUBLE, 6) AS centre_x, round(bbox_count / 0.000004::DOUBLE) AS per_area, round(scene_count / CAST(subdataset_count AS DOUBLE), 4) AS scenes_per_subdataset, array_to_string(string_split(scenes, ',')[1:5], ', ') AS first_scenes FROM d")
def e20(boxes):
    return E.density(boxes, least=1).select(
        "city_id", "grid_x", "grid_y", F.round((F.col("grid_x") + 0.5) * E.CELL, 6).alias("centre_x"), F.round(F.col("bbox_count") / 0.000004).alias("per_area"),
        F.round(F.col("scene_count") / F.col("subdataset_count"), 4).alias("scenes_per_subdataset"), F.array_join(F.slice("involved_scenes", 1, 5), ", ").alias("first_scenes"),
    )


@query("e21_hot_cells_of_city", "boxes", sql=ALL + "SELECT city_id, grid_x, grid_y, bbox_count FROM d WHERE city_id = 'A1' ORDER BY bbox_count DESC, grid_x, grid_y LIMIT 10")
def e21(boxes):
    return E.density(boxes.where("city_id = 'A1'"), least=1).orderBy(F.desc("bbox_count"), "grid_x", "grid_y").limit(10).select("city_id", "grid_x", "grid_y", "bbox_count")


@query("e23_quality_overview", "boxes", sql="SELECT count(*) AS total, count(*) FILTER (all_good) AS good, count(DISTINCT city_id) AS cities, count(DISTINCT subdataset_name) AS subdatasets FROM boxes")
def e23(boxes):
    return boxes.agg(F.count("*").alias("total"), F.count_if("all_good").alias("good"), F.countDistinct("city_id").alias("cities"), F.countDistinct("subdataset_name").alias("subdatasets"))


@query("e25_redundancy_rollup", "boxes", sql=ALL + f""", i AS (SELECT city_id, ({SHARE} / CAST(sum(bbox_count) AS DOUBLE)) / (count(*) FILTER (hot_rank <= greatest(1, round(n * 10.0::DOUBLE / 100))) / CAST(count(*) AS DOUBLE)) AS x FROM r GROUP BY 1)
SELECT CASE WHEN round(x, 2) >= 20 THEN 'severe' WHEN round(x, 2) >= 10 THEN 'moderate' ELSE 'normal' END AS band, count(*) AS cities, round(avg(round(x, 2)), 4) AS mean, round(median(round(x, 2)), 4) AS median FROM i GROUP BY 1""".replace(") , i", "), i"))
def e25(boxes):
    x = F.col("redundancy_index")
    return E.redundancy(E.density(boxes, least=1), 10.0).groupBy(E.severity(x).alias("band")).agg(F.count("*").alias("cities"), F.round(F.avg(x), 4).alias("mean"), F.round(F.median(x), 4).alias("median"))


@query("i7_box_iou", "boxes", sql="""
WITH p AS (SELECT a.scene_token AS a, b.scene_token AS b, greatest(0, least(a.xmax, b.xmax) - greatest(a.xmin, b.xmin)) * greatest(0, least(a.ymax, b.ymax) - greatest(a.ymin, b.ymin)) AS i, (a.xmax - a.xmin) * (a.ymax - a.ymin) AS sa, (b.xmax - b.xmin) * (b.ymax - b.ymin) AS sb
  FROM boxes a JOIN boxes b ON a.scene_token < b.scene_token AND a.xmin <= b.xmax AND a.xmax >= b.xmin AND a.ymin <= b.ymax AND a.ymax >= b.ymin)
SELECT a, b, round(i / nullif(sa + sb - i, 0), 6) AS overlap FROM p""")
def i7(boxes):
    met = materialize(B.folded(boxes.select(*B.BOX, "scene_token")))
    met = B.box_join(met, met).select("l_members", "r_members", F.round(iou("l_", "r_"), 6).alias("overlap"))
    return B.unfolded(met, "l_", "r_").where("l_scene_token < r_scene_token").select(F.col("l_scene_token").alias("a"), F.col("r_scene_token").alias("b"), "overlap")
