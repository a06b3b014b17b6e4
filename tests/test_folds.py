"""Equal envelopes and lines are compared once, hot cells are split, and dealt rows are never broadcast."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracelake.operators import boxes as B
from tracelake.operators import roads as R
from tracelake.plans import shapes
from tracelake.plans.inputs import read

BOXES = "scene_token string, city_id string, subdataset_name string, xmin double, ymin double, xmax double, ymax double"
CROSSINGS = "intersection_id long, intersectiontype int, intersectionsubtype int, xmin double, ymin double, xmax double, ymax double"
LANES = "lane_id long, xmin double, ymin double, xmax double, ymax double"


@pytest.fixture(scope="module")
def tables(spark):
    at = lambda k: (116.3 + k % 4 * 0.001, 39.9 + k % 3 * 0.001)
    box = lambda k, d: (*at(k), at(k)[0] + d, at(k)[1] + d)
    boxes = [(f"s{k // 2}", f"A{k % 3}", "x", *box(k, 0.0012)) for k in range(90)] + [("none", "A0", "x", 0.0, 0.0, 0.1, 0.1), ("null", "A0", "x", None, None, None, None)]
    crossings = [(k % 250, k % 5 or None, 1, *box(k * 7, 0.0003)) for k in range(300)]  # ids 0 to 49 have two envelopes or the same twice
    return spark.createDataFrame(boxes, BOXES), spark.createDataFrame(crossings, CROSSINGS)


def rows(frame):
    return sorted(map(str, frame.select(*sorted(frame.columns)).collect()))


def plainly(boxes, crossings):
    l, r = boxes.toDF(*[f"l_{c}" for c in boxes.columns]), crossings.toDF(*[f"r_{c}" for c in crossings.columns])
    met = l.join(r, (F.col("l_xmin") <= F.col("r_xmax")) & (F.col("l_xmax") >= F.col("r_xmin")) & (F.col("l_ymin") <= F.col("r_ymax")) & (F.col("l_ymax") >= F.col("r_ymin")))
    return met.select(*[F.col(f"l_{c}").alias(c) for c in ("scene_token", "city_id", "subdataset_name")], *[F.col(f"r_{c}").alias(c) for c in crossings.columns])


def test_pairs_of_folded_rows(tables):
    assert rows(B.pairs(*tables)) == rows(plainly(*tables))


@pytest.mark.parametrize("by", [(), ("city_id",), ("intersectiontype",), ("city_id", "intersectiontype"), ("scene_token",)])
def test_analysed(tables, by):
    assert rows(B.analysed(*tables, by)) == rows(B.analysis(plainly(*tables), by))


def test_hit_counts(tables):
    boxes, crossings = tables
    n = plainly(boxes, crossings).groupBy("scene_token").agg(F.count("*").alias("hits"))
    assert rows(B.hit_counts(boxes, crossings, "scene_token")) == rows(boxes.select("scene_token").join(n, "scene_token", "left").na.fill(0))


def test_hot_cells_are_split(spark):
    a, b = spark.range(900).select(F.when(F.col("id") >= 0, 1).otherwise(3).alias("g"), F.col("id").alias("a")), spark.range(500).select(F.when(F.col("id") % 100 == 99, 2).otherwise(1).alias("g"), F.col("id").alias("b"))
    found = B.cell_join(a, b, ["g"], tile=50)
    assert found.count() == found.distinct().count() == 900 * 495
    tasks = found.withColumn("task", F.spark_partition_id()).toPandas()["task"]
    assert tasks.nunique() > 1 and tasks.value_counts().max() < 0.6 * len(tasks)


def test_cells_are_split_by_what_folded_rows_hold(spark):
    g = F.when(F.col("id") >= 0, 1).otherwise(3).alias("g")
    a = spark.range(400).select(g, F.col("id").alias("a"), F.array_repeat("id", 64).alias("l_members"))
    found = B.cell_join(a, spark.range(3).select(g, F.col("id").alias("b")), ["g"])
    assert found.count() == found.select("a", "b").distinct().count() == 1200
    assert found.select(F.spark_partition_id()).distinct().count() > 1


def test_segments_of_equal_envelopes_meet_once(spark, monkeypatch):
    pts = spark.range(40 * 8).select(
        F.concat(F.lit("t"), (F.col("id") / 8).cast("int")).alias("dataset_name"), F.col("id").alias("seq"), (F.col("id") % 8).alias("ts"),
        (116.3 + F.col("id") % 8 * 0.00001).alias("lon"), (39.9 + F.col("id") % 8 * 0.00001).alias("lat"), (F.col("id") % 5).cast("double").alias("twist_linear"), F.lit(0.0).alias("yaw"),
    )
    met, join = [], B.box_join
    monkeypatch.setattr(B, "box_join", lambda a, b, *more, **options: met.append(a) or join(a, b, *more, **options))
    found = shapes.near_pairs(pts, "avg_speed").collect()
    assert len({(r["l_o"], r["r_o"]) for r in found}) == len(found) == 40 * 39 / 2
    assert met[0].count() == 1


def test_placed_segments_are_worked_out_once(spark):
    assert "Window" not in shapes.placed(read(spark, "/root/testdata/sf0.001", "pts"))._jdf.queryExecution().executedPlan().toString()


def test_dealt_rows_are_not_broadcast(spark, tables):
    boxes, crossings = tables
    points = spark.range(40).select(F.lit("t").alias("dataset_name"), F.col("id").alias("seq"), (116.3 + F.col("id") * 0.0001).alias("lon"), F.lit(39.9).alias("lat"))
    lanes = crossings.withColumnRenamed("intersection_id", "lane_id")
    for found in (B.cell_join(boxes, crossings.select("xmin", "intersection_id"), ["xmin"]), R.near_lanes(points, lanes, 50, key=["dataset_name", "seq"], k=3)):
        joins = [x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in x and "Inner" in x]
        assert joins and all("SortMergeJoin" in x for x in joins)


def test_lane_classes(spark):
    line = lambda k: (116.3, 39.9 + k * 0.00005, 116.301, 39.9 + k * 0.00005)
    lanes = spark.createDataFrame([(n, *line(n % 3)) for n in range(40)] + [(7, *line(1)), (8, *line(0)), (8, *line(2)), (None, *line(1))], LANES)
    points = spark.createDataFrame([(f"t{k % 3}", k, 116.3 + k * 0.0001, 39.9 + k % 4 * 0.00002) for k in range(12)], "dataset_name string, seq long, lon double, lat double")
    plain = R.near_lanes(points, lanes, 15).groupBy("dataset_name").agg(F.count("*").alias("total_points"), F.countDistinct("lane_id").alias("lane_count"))
    assert rows(R.lane_counts(R.near_lanes(points, R.lane_classes(lanes), 15))) == rows(plain)
    assert R.lane_classes(lanes).count() < 10
    ids = R.near_lanes(points, lanes.dropna(), 15).select("dataset_name", "lane_id").distinct()
    assert rows(R.named(R.touched_lanes(points, lanes.dropna(), 15), lanes.dropna(), "lane_id")) == rows(ids)
    near = R.near_lanes(points, lanes.dropna().dropDuplicates(["lane_id"]), 15, key=["dataset_name", "seq"], k=5)
    each = near.groupBy("dataset_name", "seq").agg(F.collect_list(F.struct("nth", "lane_id")).alias("x"))
    assert all([r.nth for r in sorted(e.x)] == [1, 2, 3, 4, 5] for e in each.collect())


def test_equal_rings_and_places(spark):
    from tracelake.operators import polygons as P
    from tracelake.operators import workflows as W

    ring = lambda k: [[(116.3 + k * 0.001, 39.9), (116.302 + k * 0.001, 39.9), (116.302 + k * 0.001, 39.902), (116.3 + k * 0.001, 39.902)]]
    polygons = spark.createDataFrame([(n, ring(n % 3)) for n in range(300)], "polygon_id long, rings array<array<struct<x:double,y:double>>>")
    points = spark.createDataFrame([(f"t{k % 2}", 10 - k, k, 116.3005 + k * 0.0005, 39.901, 1.0, 1) for k in range(8)] * 1, "dataset_name string, ts long, seq long, lon double, lat double, twist_linear double, avp_flag int")
    assert P.in_shapes(points, polygons).count() < 100  # arrays of ids, where there are hundreds of pairs
    found = P.in_polygons(points, polygons).select("seq", "polygon_id").collect()
    want = {(k, n) for k in range(8) for n in range(300) if n % 3 * 0.001 <= 0.0005 + k * 0.0005 + 1e-9 and 0.0005 + k * 0.0005 - 1e-9 <= n % 3 * 0.001 + 0.002}
    assert len(found) == len(want) and {(r.seq, r.polygon_id) for r in found} == want
    ids = {r.dataset_name: r.polygon_ids for r in W.polygon_trajectories(points, polygons).collect()}
    assert ids == {t: sorted({n for k, n in want if f"t{k % 2}" == t}) for t in ("t0", "t1")}
    areas = spark.createDataFrame([(n, f"s{n}", 116.3, 39.9, 116.302, 39.902) for n in range(5)], "polygon_id long, source string, xmin double, ymin double, xmax double, ymax double")
    plain = W.result_rows(W.point_sources(points, areas)).select("dataset_name", "source_polygons")
    assert rows(W.result_rows(points, areas=areas).select("dataset_name", "source_polygons")) == rows(plain)


def test_trajectories_are_joined_without_broadcasts(spark):
    """There are as many as the input gives; small tables would be broadcast if these joins were left to Spark."""
    from tracelake.operators import workflows as W

    points = spark.createDataFrame([(f"t{k}", i, i, 116.3 + i * 1e-4, 39.9 + k * 1e-4, 5.0, 1) for k in range(3) for i in range(8)], "dataset_name string, ts long, seq long, lon double, lat double, twist_linear double, avp_flag int")
    lanes = spark.createDataFrame([(1, 116.3, 39.9, 116.301, 39.9), (2, 116.3, 39.9001, 116.301, 39.9001)], "lane_id long, xmin double, ymin double, xmax double, ymax double")
    for frame, rows in ((W.complete_trajectories(points, lanes), 3), (W.lane_statistics(points, lanes), 1)):
        assert len(frame.collect()) == rows
        assert "BroadcastHashJoin [dataset_name" not in frame._jdf.queryExecution().executedPlan().toString()


def test_distances_of_members(spark):
    """Members of rows that meet are measured where they meet, and not listed as pairs before."""
    import random

    from tests.plain import frechet, hausdorff
    from tracelake.operators import shapes as S

    rng = random.Random(3)
    line = lambda n: [(116.3 + rng.random() * 0.001, 39.9 + rng.random() * 0.001) for _ in range(n)]
    lines = {f"t{k}": line(rng.choice([0, 1, 2, 5, 6, 9])) for k in range(60)} | {"none": None, "hole": [(116.3, None), (116.31, 39.9)], "twin": [(1.0, 2.0)] * 2, "twin too": [(1.0, 2.0)] * 2}
    names = list(lines)
    blocks = [(names[a : a + 7], names[b : b + 7]) for a in range(0, len(names), 7) for b in range(0, len(names), 7)]
    rows = [tuple([(o, lines[o]) for o in side] for side in block) for block in blocks]
    member = "array<struct<o:string,line:array<struct<lon:double,lat:double>>>>"
    met = spark.createDataFrame(rows, f"l_members {member}, r_members {member}").repartition(1)
    pairs = B.unfolded(met, "l_", "r_").where("l_o < r_o")
    wanted = {(r.l_o, r.r_o): r.d for r in pairs.select("l_o", "r_o", S.segment_distance(F.col("l_line"), F.col("r_line")).alias("d")).collect()}
    for measure, plain in ((S.farthest("frechet"), frechet), (S.farthest("hausdorff"), hausdorff), (S.segment_distances, None)):
        found = S.member_distances(met, measure, 4)
        assert "explode" not in found._jdf.queryExecution().executedPlan().toString()
        got = {(r.a, r.b): r.distance for r in found.collect()}
        assert got.keys() == wanted.keys() and len(got) == len(names) * (len(names) - 1) / 2
        for (a, b), d in got.items():
            whole = lines[a] and lines[b] and "hole" not in (a, b)
            if plain:
                assert d == pytest.approx(plain(np.array(lines[a]), np.array(lines[b])), abs=1e-4) if whole else d is None
            elif whole:
                assert d == pytest.approx(wanted[a, b], abs=1e-4)
    features = "array<struct<o:string,p:double,q:double>>"
    met = spark.createDataFrame([([("b", 0.0, 0.0), ("c", 1.0, None)], [("a", 3.0, 4.0), ("c", 1.0, None), ("d", 0.00004, 0.0)])], f"l_members {features}, r_members {features}")
    assert {tuple(r) for r in S.member_distances(met, S.feature_distances, 4).collect()} == {("b", "c", None), ("b", "d", 0.0), ("c", "d", None)}


def test_boxes_of_equal_envelopes_meet_once(spark, monkeypatch):
    from tracelake.operators import clustering as C
    from tracelake.plans import places

    at = [0.0, 0.001, 0.01]
    rows = [(f"s{k:03d}", None if k % 4 == 3 else f"A{k % 4}", at[k % 3], 0.0, at[k % 3] + 0.0015, 0.002) for k in range(240)] + [("null", "A0", None, None, None, None)]
    boxes = spark.createDataFrame(rows, "scene_token string, city_id string, xmin double, ymin double, xmax double, ymax double")
    seen = []
    for module in (B, C):
        join = module.box_join
        monkeypatch.setattr(module, "box_join", lambda a, b, join=join: seen.append(a.count()) or join(a, b))
    parts = {r.scene_token: r.part for r in C.touching(boxes, "city_id", "scene_token").collect()}
    assert seen == [4 * 3, 4 * 2]  # three places in each of four cities, of which two meet
    groups = {}
    for k in range(240):
        groups.setdefault((k % 4, k % 3 == 2), set()).add(parts[f"s{k:03d}"])
    assert all(len(g) == 1 for g in groups.values()) and len(set(parts.values())) == 9
    seen.clear()
    found = places.i7(boxes).collect()
    assert seen[0] < 20 and len(found) == len({(r.a, r.b) for r in found}) == 160 * 159 / 2 + 80 * 79 / 2
    assert {round(r.overlap, 3) for r in found} == {1.0, 0.2}


def test_features_and_envelopes_come_from_one_pass(spark):
    from tracelake.operators import trajectories as T

    cut = read(spark, "/root/testdata/sf0.001", "pts").withColumn("segment_index", F.lit(0))
    found = T.segments(cut, F.max("lon").alias("xmax"))
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found.select("dataset_name", "xmax")) == rows(cut.groupBy("dataset_name").agg(F.max("lon").alias("xmax")))
