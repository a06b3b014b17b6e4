"""Small cases whose results are known by hand."""

import base64
import gzip
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests import plain
from tracelake.functions import geo, text
from tracelake.operators import boxes, clustering, datasets, density, media, quality_check, retrieval, roads, trajectories
from tracelake.operators.polygons import in_polygons
from tracelake.sources import datasets as files
from tracelake.sources import geojson
from tracelake.streaming import live

POINT = "dataset_name string, seq long, ts long, lon double, lat double, twist_linear double, yaw double, avp_flag int, workstage int"


def track(spark, rows, name="t"):
    """Points from ``(ts, metres north)``."""
    return spark.createDataFrame([(name, i + 1, t, 0.0, m / 111194.9266, 5.0, 0.0, None, 2) for i, (t, m) in enumerate(rows)], POINT)


def one(frame, expr):
    return frame.select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("line, want", [("s3://lake/day7/part-3@duplicate4", ("s3://lake/day7/part-3", 4)), (" lake/x@duplicate0 ", ("lake/x", 0)), ("   ", None), ("lake/x", None), ("@duplicate3", None), ("lake/x@duplicate2@duplicate3", None), ("lake/x@duplicate1.5", None)])
def test_index_lines(spark, line, want):
    got = one(spark.createDataFrame([(line,)], "v string"), text.index_line(F.col("v")))
    assert (tuple(got) if got else None) == want


def test_names(spark):
    f = spark.createDataFrame([("GOD_E2E_lane_change_sub_ddi_1", "x/god/A1/train_god_2/y"), ("GOD_E2E_turn_277abce2e_x", "x/god/q/GOD_E2E_B/z/f"), ("_", "x/parent/f"), ("stop_2025_01_02_03_04_05", "f")], "n string, p string")
    got = f.select(text.normal_name(F.col("n")).alias("n"), text.subdataset_name(F.col("p")).alias("s"), text.table_name(F.col("n")).alias("t")).collect()
    assert [r.n for r in got] == ["lane_change", "turn", "unnamed_dataset", "stop"]
    assert [r.s for r in got] == ["A1", "GOD_E2E_B", "parent", None]
    assert got[0].t == "clips_bbox_lane_change"


def test_field_types(spark):
    f = spark.createDataFrame([("true", "a"), ("1", "b"), ("1.5", "b"), ("x", "c"), (None, "c"), ("False", "a")], "v string, k string")
    got = {r.k: r.t for r in f.groupBy("k").agg(text.merged_type(text.field_type(F.col("v"))).alias("t")).collect()}
    assert got == {"a": "boolean", "b": "numeric", "c": "text"}


def test_defect_lines_and_text(spark):
    f = spark.createDataFrame([("http://h/?dataName=d1&x=2|a=1| flag ",), ("no url",)], "value string")
    got = datasets.defect_lines(f).collect()
    assert [(r.data_name, r.attributes) for r in got] == [("d1", {"a": "1", "flag": "true"})]
    again = spark.createDataFrame([("http://h/?dataName=d2|a=1|b=2| a = 3 |flag|flag",)], "value string")
    assert datasets.defect_lines(again).first().attributes == {"a": "3", "b": "2", "flag": "true"}
    gbk = "轨迹 7".encode("gbk").decode("latin-1")
    assert [r.x for r in spark.createDataFrame([(gbk,), ("é\xff",), (None,)], "t string").select(text.repaired(F.col("t")).alias("x")).collect()] == ["轨迹 7", "é\xff", None]
    broken = "中文".encode().decode("latin-1")
    assert [r.x for r in spark.createDataFrame([(broken,), ("plain",), ("中文",)], "t string").select(text.repaired(F.col("t")).alias("x")).collect()] == ["中文", "plain", "中文"]
    heads = [b"\xff\xd8\xff\xe0", b"\x89PNG\r\n\x1a\n", b"GIF89a", b"RIFF0000WEBP", b"BM12", b"?"]
    assert [r.x for r in spark.createDataFrame([(bytearray(h),) for h in heads], "b binary").select(text.image_format(F.col("b")).alias("x")).collect()] == ["jpeg", "png", "gif", "webp", "bmp", "unknown"]


def test_degenerate_boxes(spark):
    f = spark.createDataFrame([("a", 0.0, 2.0, 1.0, 1.0), ("b", 0.0, 1.0, 0.0, 1.0)], "k string, xmin double, xmax double, ymin double, ymax double")
    got = {r.k: r for r in boxes.shaped(f).collect()}
    assert (got["a"].shape, got["a"].xmin, got["a"].xmax) == ("POINT", 1.0, 1.0) and got["b"].shape == "POLYGON"


def test_all_good_ignores_nulls(spark):
    rows = [("a", 1, 0, 0.0, 0.0, 1.0, 0.0, 0, w) for w in (2, 2, None)] + [("b", 1, 0, 0.0, 0.0, 1.0, 0.0, 0, w) for w in (2, 1)]
    got = {r.dataset_name: r.all_good for r in boxes.extents(spark.createDataFrame(rows, POINT), "dataset_name").collect()}
    assert got == {"a": True, "b": False}


def test_box_join_against_all_pairs(spark):
    r = np.random.default_rng(1)
    make = lambda n, w: [(i, float(x), float(y), float(x + a), float(y + b)) for i, (x, y, a, b) in enumerate(zip(r.uniform(0, 0.05, n), r.uniform(0, 0.05, n), r.uniform(0, w, n), r.uniform(0, w, n)))]
    a, b = make(80, 0.01), make(90, 0.003)
    schema = "id int, xmin double, ymin double, xmax double, ymax double"
    fa, fb = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    meets = lambda p, q, d=0.0: max(0, p[1] - q[3], q[1] - p[3]) ** 2 + max(0, p[2] - q[4], q[2] - p[4]) ** 2 <= d * d
    found = lambda **kw: sorted((r.l_id, r.r_id) for r in boxes.box_join(fa, fb, **kw).collect())
    assert found() == sorted((p[0], q[0]) for p in a for q in b if meets(p, q))
    assert found(how="dwithin", distance=0.002) == sorted((p[0], q[0]) for p in a for q in b if meets(p, q, 0.002))
    assert found(how="contains") == sorted((p[0], q[0]) for p in a for q in b if p[1] <= q[1] and p[2] <= q[2] and p[3] >= q[3] and p[4] >= q[4])
    counts = {r.id: r.hits for r in boxes.hit_counts(fa, fb.limit(3), "id").collect()}
    assert len(counts) == 80 and 0 in counts.values()


def test_point_in_polygon(spark):
    ring = [(0.0, 0.0), (0.004, 0.0), (0.004, 0.004), (0.002, 0.001), (0.0, 0.004)]
    polygons = spark.createDataFrame([("p", [ring])], "polygon_id string, rings array<array<struct<x:double,y:double>>>")
    at = {1: (0.001, 0.001, True), 2: (0.002, 0.003, False), 3: (0.0, 0.002, True), 4: (0.002, 0.001, True), 5: (0.005, 0.001, False), 6: (0.0035, 0.003, True)}
    points = spark.createDataFrame([("d", k, 0, x, y) for k, (x, y, _) in at.items()], "dataset_name string, seq int, ts int, lon double, lat double")
    assert {r.seq for r in in_polygons(points, polygons).collect()} == {k for k, v in at.items() if v[2]}


def test_segments_cut_at_fifty_metres_gaps_and_short_ones(spark):
    got = trajectories.segmented(track(spark, [(i, 9 * i) for i in range(12)])).groupBy("segment_index").count().collect()
    assert {r.segment_index: r["count"] for r in got} == {0: 6, 1: 6}
    gap = trajectories.segmented(track(spark, [(i, i) for i in range(5)] + [(10 + i, 6 + i) for i in range(6)])).groupBy("segment_index").count().collect()
    assert {r.segment_index: r["count"] for r in gap} == {0: 5, 1: 6}
    short = trajectories.segmented(track(spark, [(i, i) for i in range(4)] + [(10 + i, 6 + i) for i in range(6)])).groupBy("segment_index").count().collect()
    assert {r.segment_index: r["count"] for r in short} == {0: 6}
    assert trajectories.segmented(track(spark, [(i, i) for i in range(4)])).count() == 0


def test_segment_quality(spark):
    flag = lambda rows: trajectories.segments(track(spark, rows).withColumn("segment_index", F.lit(0))).first().quality_flag
    assert flag([(i, i * 200) for i in range(5)]) == "gps_jump"
    assert flag([(i, i) for i in range(5)]) == "stationary"
    assert flag([(i, i * 5) for i in range(6)]) == "moving"


def test_spikes_and_changes(spark):
    rows = [("t", i + 1, i, 0.0, 0.0, v, 0.0, a, 2) for i, (v, a) in enumerate([(5.0, None), (5.0, 0), (5.0, 1), (None, 1), (5.0, None)])]
    points = spark.createDataFrame(rows, POINT)
    assert trajectories.speed_spikes(points).count() == 0
    assert [(r.from_avp, r.to_avp) for r in trajectories.avp_changes(points).orderBy("seq").collect()] == [(0, 1), (1, 0)]
    fast = spark.createDataFrame([("t", i, i, 0.0, 0.0, v, 0.0, 0, 2) for i, v in enumerate([1.0] * 20 + [50.0])], POINT)
    assert [r.seq for r in trajectories.speed_spikes(fast).collect()] == [20]
    assert trajectories.events(fast).columns[:4] == ["dataset_name", "ts", "seq", "event_type"]


def test_headings_and_distances(spark):
    f = spark.range(1)
    assert one(f, geo.heading_difference(F.lit(350.0), F.lit(10.0))) == 20
    assert one(f, geo.bearing(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0))) == pytest.approx(90)
    assert one(f, geo.haversine(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))) == pytest.approx(math.pi / 180 * 6371000)
    assert one(f, geo.haversine(F.lit(None).cast("double"), F.lit(0.0), F.lit(0.0), F.lit(1.0))) is None
    clip = lambda *v: one(f, geo.clipped_fraction(*[F.lit(float(x)) for x in v]))
    assert clip(-1, 0.5, 1, 0.5, 0, 0, 1, 1) == pytest.approx(0.5) and clip(-1, 2, 1, 2, 0, 0, 1, 1) == 0 and clip(0, 0, 1, 1, 0, 0, 1, 1) == 1
    wkt = geo.wkt_line(geo.parse_wkt_line(F.lit("LINESTRING Z (1 2 9, 3.5 4 9)")))
    assert one(f, wkt) == "LINESTRING (1.0 2.0, 3.5 4.0)"


def test_lane_rules(spark):
    hits = [("two", 1), ("two", 2), *[("five", 1)] * 5, *[("four", 1)] * 4]
    got = {r.dataset_name: r.reason for r in roads.lane_rules(spark.createDataFrame(hits, "dataset_name string, lane_id int")).collect()}
    assert got == {"two": "multi_lane_2_lanes", "five": "sufficient_points_5_points"}


def test_road_chains(spark):
    edges = spark.createDataFrame([(1, 2, 300.0), (2, 3, 150.0), (3, 4, 100.0), (4, 1, 100.0)], "roadid long, nextroadid long, length double")
    got = roads.chains(edges, spark.createDataFrame([(1,)], "roadid long"), 500.0).collect()
    assert sorted(tuple(r) for r in got) == [(2, 0, 0.0), (3, 1, 300.0), (4, 2, 450.0)]


def test_time_ranges(spark):
    points = track(spark, [(i, i) for i in range(4)])
    ranges = spark.createDataFrame([("t", 0, 1.0, 2.0)], "dataset_name string, range_no int, lo double, hi double")
    assert quality_check.cut_by_ranges(points, ranges).count() == 0  # under five seconds: skipped
    long = track(spark, [(i, i) for i in range(0, 101, 10)])
    wide = spark.createDataFrame([("t", 0, 19.0, 24.0), ("t", 1, -9.0, -1.0), ("t", 2, 101.0, 120.0), ("t", 3, 41.0, 49.0)], "dataset_name string, range_no int, lo double, hi double")
    got = quality_check.cut_by_ranges(long, wide).collect()
    assert sorted((r.range_no, r.ts, r.tolerance) for r in got) == [(3, 40, 1.0), (3, 50, 1.0)]


def test_labels(spark):
    f = spark.createDataFrame([("['b ', 'a', 'b']", "[[1, 2.5], [4, 3]]"), ("x", "bad"), (None, None)], "r string, d string")
    got = f.select(quality_check.labels(F.col("r")).alias("l"), text.time_ranges(F.col("d")).alias("t")).collect()
    assert [r.l for r in got] == [["b ", "a", "b"], ["x"], None] and got[0].t == [[1.0, 2.5]]


def test_merge_and_top_shares(spark):
    rows = [("g", "A", 0.0, 0.0, 1.0, 1.0), ("g", "B", 0.0, 0.0, 1.0, 0.9), ("g", "C", 5.0, 5.0, 6.0, 6.0)]
    got = clustering.merge_overlapping(spark.createDataFrame(rows, "g string, k string, xmin double, ymin double, xmax double, ymax double"), "g", "k").collect()
    assert sorted((r.sources, r.merged_count) for r in got) == [("A,B", 2), ("C", 1)]
    cells = spark.createDataFrame([("c", i, 0, 150 - i) for i in range(150)], "city_id string, grid_x long, grid_y long, bbox_count long")
    assert density.top_share(cells, 1.0, "int").count() == 1 and density.top_share(cells, 1.0, "round").count() == 2


def test_clusters():
    r = np.random.default_rng(2)
    x = np.concatenate([r.normal(0, 0.1, (20, 3)), r.normal(5, 0.1, (20, 3)), [[50.0, 0, 0]]])
    labels = plain.dbscan(x, 0.8, 5)
    assert labels[:20].tolist() == [0] * 20 and labels[20:40].tolist() == [1] * 20 and labels[40] == -1
    two = plain.ward(x[:40], 2)
    assert len(set(two[:20])) == 1 and len(set(two[20:])) == 1 and two[0] != two[20]
    assert plain.silhouette(x[:40], two) > 0.9 and plain.davies_bouldin(x[:40], two) < 0.1
    a, b = np.array([(0.0, 0.0), (1.0, 0.0)]), np.array([(0.0, 1.0), (1.0, 1.0)])
    assert plain.frechet(a, b) == pytest.approx(plain.hausdorff(a, b), rel=1e-3)


def test_routes_and_windows(spark):
    f = spark.createDataFrame([("https://www.amap.com/dir/77/?src=1.5,2&dest=3,4", "1,2;3,4;x"), ("https://other.com/77", "")], "u string, p string")
    got = f.select(media.route_id(F.col("u")).alias("id"), media.coordinates(F.col("u"), "src").alias("c"), media.polyline(F.col("p")).alias("l")).collect()
    assert got[0].id == "77" and tuple(got[0].c) == (1.5, 2.0) and [tuple(p) for p in got[0].l] == [(1.0, 2.0), (3.0, 4.0)] and got[1].id is None and got[1].l == []
    hits = spark.createDataFrame([("a", 0), ("a", 10**12), (None, 5)], "dataset_name string, timestamp_ms long")
    rows = {r.dataset_name: (r.hits, r.start_ms) for r in retrieval.windows(hits).collect()}
    assert rows == {"a": (2, 10**12 - 43200000), "unknown": (1, 5 - 43200000)}


def test_files(spark, tmp_path):
    scene = lambda i: json.dumps({"scene_id": i})
    a, b = tmp_path / "god_a.shrink", tmp_path / "b.shrink"
    a.write_text(scene("001") + "\n" + base64.b64encode(gzip.compress(scene("002").encode())).decode() + "\nbad\n")
    b.write_text(scene("003") + "\n")
    index = tmp_path / "index.txt"
    index.write_text(f"{a}@duplicate20\n\nbroken\n{b}@duplicate10\n")
    items = files.read_scenes(spark, str(index))
    assert sorted((r.scene_id, r.duplication_factor) for r in items.collect()) == [("001", 20), ("002", 20), ("003", 10)]
    assert datasets.duplicated(items).count() == 50
    out = str(tmp_path / "d.parquet")
    files.write_dataset(items, out, meta={"name": "d", "metadata": {"k": 1}})
    meta = files.read_meta(spark, out)
    assert (meta["name"], meta["metadata"], meta["total_unique_scenes"]) == ("d", {"k": 1}, items.count()) and meta["total_scenes"] >= items.count()
    with pytest.raises(ValueError, match="without scenes"):
        files.write_dataset(items.limit(0), str(tmp_path / "none.parquet"))
    assert sorted(len(r.scene_ids) for r in files.read_dataset(spark, out).collect()) == [1, 2]
    assert files.read_ids(spark, out).count() == 3
    assert [r.json for r in files.decoded_lines(spark.createDataFrame([("{}",), ("!",), (None,)], "value string")).collect()] == ["{}", None, None]
    shape = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"id": "x"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]], [[0.5, 0.1], [0.8, 0.1], [0.8, 0.4], [0.5, 0.1]]]}}, {"type": "Feature", "properties": {}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1]]], [[[5, 5], [6, 5], [6, 6]]]]}}, {"type": "Feature", "properties": {"scene_id": "s", "data_name": "d"}, "geometry": {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}}]}
    path = tmp_path / "p.geojson"
    path.write_text(json.dumps(shape))
    got = {r.polygon_id: [len(x) for x in r.rings] for r in geojson.read_polygons(spark, str(path)).collect()}
    assert got == {"x": [3, 3], "polygon_1": [3], "polygon_1_1": [3]}
    assert [(r.scene_id, len(r.line)) for r in geojson.read_lines(spark, str(path)).collect()] == [("s", 2)]


def test_streams(spark, tmp_path):
    points = track(spark, [(i, i) for i in range(20)])
    points.withColumn("at", F.timestamp_seconds("ts")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))
    for name, frame, mode in (("extents", live.live_extents(stream), "complete"), ("cells", live.windowed_density(stream, "at"), "complete"), ("runs", live.sessions(stream, "at"), "append")):
        query = frame.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
        query.awaitTermination(120)
    assert spark.table("extents").count() == 1 and spark.table("cells").agg(F.sum("points")).first()[0] == 20
    live.upserting(stream.select("dataset_name", "ts"), str(tmp_path / "out"), str(tmp_path / "check"), ["dataset_name", "ts"]).trigger(availableNow=True).start().awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20


def test_chains_of_a_clique_stay_distinct(spark):
    edges = [(a, b, 5.0) for a in range(4) for b in range(4) if a != b] + [(3, 9, None), (9, 10, 20.0)]
    got = roads.chains(spark.createDataFrame(edges, "roadid int, nextroadid int, length double"), spark.createDataFrame([(0,)], "roadid int"), 500.0)
    rows = got.collect()
    level, want = {(b, 0.0, x or 0.0) for a, b, x in edges if a == 0}, set()
    for d in range(11):
        want |= {(b, d, at) for b, at, _ in level}
        level = {(b, at + x, y or 0.0) for r, at, x in level if at + x <= 500 for a, b, y in edges if a == r}
    assert len(rows) == len(want) < 100 and {tuple(r) for r in rows} == want
    assert any(r.road_id == 10 for r in rows)  # a null length doesn't end the chain


def test_merged_roads_keep_the_first_kind(spark):
    f = lambda *ids: spark.createDataFrame([(i,) for i in ids], "road_id int")
    got = {r.road_id: r.kind for r in roads.merged_roads(direct=f(1, 2), chain=f(2, 3, 3), intersection=f(3, 4)).collect()}
    assert got == {1: "direct", 2: "direct", 3: "chain", 4: "intersection"}


def test_segment_distance_and_curvature(spark):
    from tracelake.operators import shapes

    line = lambda *p: [{"lon": x, "lat": y} for x, y in p]
    rows = [(line((0.0, 0.0), (1.0, 0.0)), line((0.0, 0.0), (1.0, 0.0))), (line((0.0, 0.0), (1.0, 0.0)), line((2.0, 0.0), (3.0, 0.0))), (line((0.0, 0.0), (1.0, 0.0)), line((0.0, 0.0), (0.0, 1.0))), (line((0.0, 0.0)), line((0.0, 0.0), (0.0, 1.0)))]
    got = [r.d for r in spark.createDataFrame(rows, "a array<struct<lon:double,lat:double>>, b array<struct<lon:double,lat:double>>").select(shapes.segment_distance(F.col("a"), F.col("b")).alias("d")).collect()]
    degree = 6371000 * 3.141592653589793 / 180
    assert got[0] == 0 and got[1] == pytest.approx(0.6 * 1.5 * degree + 0.3 * 1.5) and got[3] == float("inf")
    assert got[2] == pytest.approx(0.6 * 0.5 * degree + 0.1 * 10 * 3.141592653589793 / 2)
    circle = [(float(i), i, 2 * math.cos(i / 3), 2 * math.sin(i / 3), "c") for i in range(9)] + [(0.0, 0, 1.0, 1.0, "two"), (1.0, 1, 2.0, 2.0, "two")]
    bent = {r.k: (r.triples, r.curvature) for r in shapes.mean_curvature(spark.createDataFrame(circle, "ts double, seq int, lon double, lat double, k string"), "k").collect()}
    assert bent == {"c": (7, pytest.approx(0.5))}


def test_adaptive_segments(spark):
    speeds = [5.0] * 8 + [0.1] + [5.0] * 7
    rows = [("t", i + 1, i, i * 1e-4, 0.0, v) for i, v in enumerate(speeds)] + [("few", i, i, 0.0, 0.0, 5.0) for i in range(4)] + [("plain", i, i, i * 1e-4, 0.0, 5.0) for i in range(6)]
    got = [tuple(r) for r in shapes_of(spark, rows)]
    assert got == [("plain", 0, 0, 5), ("t", 0, 0, 7), ("t", 1, 7, 15)]


def shapes_of(spark, rows):
    from tracelake.operators import shapes

    return shapes.adaptive_segments(spark.createDataFrame(rows, "dataset_name string, seq int, ts int, lon double, lat double, twist_linear double")).orderBy("dataset_name", "segment_index").collect()


def test_hull_of_exact_points_in_parts(spark):
    r = np.random.default_rng(3)
    rows = [(str(i % 3), float(x), float(y)) for i, (x, y) in enumerate(r.standard_normal((300, 2)))] + [("0", None, 1.0), ("one", 2.0, 2.0), ("two", 0.0, 0.0), ("two", 1.0, 1.0)]
    got = {x.city_id: x for x in clustering.convex_hull(spark.createDataFrame(rows, "city_id string, lon double, lat double").repartition(5), "city_id").collect()}
    for k in "012":
        p = np.array([(x, y) for c, x, y in rows if c == k and x is not None])
        ring = np.array([[float(v) for v in q.split()] for q in got[k].hull[10:-2].split(", ")])
        assert got[k].corners == len(ring) - 1 and {tuple(q) for q in ring.tolist()} <= {tuple(q) for q in p.tolist()}
        for a, b in zip(ring, ring[1:], strict=False):  # every point lies to the left of every side
            assert ((b[0] - a[0]) * (p[:, 1] - a[1]) - (b[1] - a[1]) * (p[:, 0] - a[0]) >= -1e-12).all()
    assert got["one"].corners == 1 and got["two"].corners == 2


def test_boxes_merge_as_in_one_list(spark):
    r = np.random.default_rng(4)
    rows = []
    for i in range(120):
        x, y, w = r.uniform(0, 0.02), r.uniform(0, 0.02), r.uniform(0.001, 0.003)
        rows.append((f"s{i:03d}", str(i % 2), x, y, x + w, y + w))
        rows.append((f"t{i:03d}", str(i % 2), x, y, x + w * r.uniform(0.8, 1.2), y + w))
    got = clustering.merge_overlapping(spark.createDataFrame(rows, "scene_token string, city_id string, xmin double, ymin double, xmax double, ymax double"), "city_id", "scene_token").collect()
    want = []
    for city in "01":
        unions = []
        for name, _, *b in sorted(x for x in rows if x[1] == city):
            for u in unions:
                both = max(0, min(u[2], b[2]) - max(u[0], b[0])) * max(0, min(u[3], b[3]) - max(u[1], b[1]))
                if both >= 0.7 * ((u[2] - u[0]) * (u[3] - u[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both):
                    u[:4] = min(u[0], b[0]), min(u[1], b[1]), max(u[2], b[2]), max(u[3], b[3])
                    u[4].append(name)
                    break
            else:
                unions.append([*b, [name]])
        want += [(city, ",".join(u[4]), len(u[4])) for u in unions]
    assert sorted((x.city_id, x.sources, x.merged_count) for x in got) == sorted(want)


def test_training_json_and_defects(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"meta": {"release_name": "r1", "description": "d"}, "name": "n", "dataset_index": [{"name": "a", "obs_path": "p/a", "duplicate": 3}, {"name": "b", "obs_path": "p/b"}, {"name": "c"}, {"obs_path": "p/d"}]}))
    (tmp_path / "u.json").write_text(json.dumps({"name": "only", "dataset_index": [{"name": "z", "obs_path": "q"}]}))
    got = [tuple(r) for r in files.read_training_json(spark, str(tmp_path / "t.json")).orderBy("subdataset_name").collect()]
    assert got == [("r1", "a", "p/a", 3), ("r1", "b", "p/b", 1)]
    assert files.read_training_json(spark, str(tmp_path / "u.json")).first().dataset_name == "only"
    (tmp_path / "d.txt").write_text("http://h/?dataName=d1|k=v|k=w|flag\n\nnothing\n")
    assert [(r.data_name, r.attributes) for r in files.read_defects(spark, str(tmp_path / "d.txt")).collect()] == [("d1", {"k": "w", "flag": "true"})]
    (tmp_path / "ids.txt").write_text("s1\n# no\n\n s2 \ns1\n")
    (tmp_path / "ids.json").write_text(json.dumps({"subdatasets": [{"scene_ids": ["s3", "s4"]}, {"scene_ids": ["s3"]}]}))
    assert sorted(r[0] for r in files.read_ids(spark, str(tmp_path / "ids.txt")).collect()) == ["s1", "s2"]
    assert sorted(r[0] for r in files.read_ids(spark, str(tmp_path / "ids.json")).collect()) == ["s3", "s4"]


def test_written_features_and_boxes(spark, tmp_path):
    from tracelake.sources import tables

    line = [{"lon": 1.0, "lat": 2.0}, {"lon": 3.0, "lat": 4.0}]
    geojson.write_lines(spark.createDataFrame([("d", ["p1", "p2"], line)], "dataset_name string, polygon_ids array<string>, line array<struct<lon:double,lat:double>>"), str(tmp_path / "one"))
    feature = json.loads(spark.read.text(str(tmp_path / "one")).first()[0])
    assert feature["geometry"] == {"type": "LineString", "coordinates": [[1.0, 2.0], [3.0, 4.0]]} and feature["properties"] == {"dataset_name": "d", "polygon_ids": "p1,p2"}
    geojson.write_lines(spark.createDataFrame([("d", [line, line])], "dataset_name string, line array<array<struct<lon:double,lat:double>>>"), str(tmp_path / "many"))
    assert json.loads(spark.read.text(str(tmp_path / "many")).first()[0])["geometry"] == {"type": "MultiLineString", "coordinates": [[[1.0, 2.0], [3.0, 4.0]]] * 2}
    tables.write_boxes(spark.createDataFrame([("GOD_E2E_Lane_sub_ddi_1", 1), ("x", 2)], "subdataset_name string, n int"), str(tmp_path / "boxes"))
    back = {r.source_table: r.n for r in spark.read.parquet(str(tmp_path / "boxes")).collect()}
    assert back == {"clips_bbox_lane": 1, "clips_bbox_x": 2}


def test_annotations(spark, tmp_path):
    from tracelake.sources.annotations import read_annotations

    (tmp_path / "a.csv").write_text('task_name,annotator,autoscene_id,result,description,other_scenario\nt,me,s1, good ,"[[0, 2]]",nan\nt,me,,x,,\n')
    rows = [("t", "you", "s2", "['a']", None, "b")]
    spark.createDataFrame(rows, "task_name string, annotator string, autoscene_id string, result string, description string, other_scenario string").write.parquet(str(tmp_path / "b.parquet"))
    got = [tuple(r) for r in read_annotations(spark, str(tmp_path / "a.csv"), str(tmp_path / "b.parquet")).orderBy("autoscene_id").collect()]
    assert got == [("t", "me", "s1", "good", "[[0, 2]]", None), rows[0]]
    (tmp_path / "c.csv").write_text("task_name,annotator\nt,me\n")
    with pytest.raises(ValueError, match="autoscene_id"):
        read_annotations(spark, str(tmp_path / "c.csv"))


def test_polygons_to_trajectories_in_one_call(spark, tmp_path):
    from tracelake.operators import workflows

    square = lambda x, name: {"type": "Feature", "properties": {"polygon_id": name}, "geometry": {"type": "Polygon", "coordinates": [[[x, 0], [x + 1e-3, 0], [x + 1e-3, 1e-3], [x, 1e-3], [x, 0]]]}}
    (tmp_path / "p.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [square(0.0, "a"), square(0.002, "b"), square(1.0, "far")]}))
    rows = [("in", i, i, i * 5e-4, 5e-4, 5.0, None) for i in range(8)] + [("out", i, i, 0.5, 0.5, 5.0, None) for i in range(4)] + [("single", 0, 0, 5e-4, 5e-4, 5.0, None)]
    points = spark.createDataFrame(rows, "dataset_name string, seq int, ts int, lon double, lat double, twist_linear double, avp_flag int")
    got = workflows.polygon_workflow(spark, str(tmp_path / "p.geojson"), points, str(tmp_path / "out")).collect()
    assert [(r.dataset_name, r.polygon_ids, r.point_count) for r in got] == [("in", ["a", "b"], 8)]
    feature = json.loads(spark.read.text(str(tmp_path / "out")).first()[0])
    assert feature["properties"]["polygon_ids"] == "a,b" and len(feature["geometry"]["coordinates"]) == 8


def test_input_segments_and_mapping(spark):
    from tracelake.operators import workflows

    step = 20 / geo.METRES_PER_DEGREE
    points = spark.createDataFrame([("t", i, i, i * step, 0.0) for i in range(6)] + [("stays", i, i, 1.0, 1.0) for i in range(3)] + [("single", 0, 0, 0.0, 0.0)], "dataset_name string, seq int, ts int, lon double, lat double")
    got = [(r.dataset_name, r.segment_id, r.start_index, r.end_index, round(r.length_meters, 6), r.heading and round(r.heading, 3), round(r.lon / step, 6)) for r in workflows.input_segments(points).orderBy("dataset_name", "segment_id").collect()]
    assert got == [("stays", 0, 0, 2, 0.0, None, round(1 / step, 6)), ("t", 0, 0, 3, 60.0, 90.0, 1.5), ("t", 1, 3, 5, 40.0, 90.0, 4.0)]
    rows = [("s1", "d1", "12.0", "x", 1), ("s1", "d2", "13.0", "y", 2), ("s2", "d3", "n/a", None, 1)]
    found = workflows.scene_mapping(spark.createDataFrame(rows, "scene_id string, dataset_name string, event_id string, event_name string, updated_time int"))
    assert sorted(map(tuple, found.collect())) == [("s1", "d2", 13, "y"), ("s2", "d3", None, None)]


def test_line_distances_in_columns(spark):
    from tracelake.operators import shapes

    r = np.random.default_rng(6)
    lines = [[(float(x), float(y)) for x, y in r.uniform(0, 0.01, (n, 2))] for n in (1, 2, 5, 8, 13)]
    rows = [(i, j, [{"lon": x, "lat": y} for x, y in lines[i]], [{"lon": x, "lat": y} for x, y in lines[j]]) for i in range(5) for j in range(5)]
    frame = spark.createDataFrame(rows, "i int, j int, a array<struct<lon:double,lat:double>>, b array<struct<lon:double,lat:double>>")
    odd = spark.createDataFrame([(98, 0, None, rows[0][3]), (99, 0, [], rows[0][3])], frame.schema)
    found = shapes.line_distances(frame.unionByName(odd), "a", "b").collect()
    assert len(found) == 27 and all(x.frechet is None and x.hausdorff is None for x in found if x.i > 90)
    for x in found:
        if x.i < 90:
            a, b = np.array(lines[x.i]), np.array(lines[x.j])
            assert x.frechet == pytest.approx(plain.frechet(a, b)) and x.hausdorff == pytest.approx(plain.hausdorff(a, b))


def test_distances_of_long_lines():
    from tracelake.operators import shapes

    r = np.random.default_rng(7)
    a, b = np.cumsum(r.standard_normal((2, 1000, 2)) * 1e-4, axis=1)
    f, h = shapes.diagonals(np.radians(a[None]), np.radians(b[None]))
    assert f[0] == pytest.approx(plain.frechet(a, b)) and h[0] == pytest.approx(plain.hausdorff(a, b))
