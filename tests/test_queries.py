"""Registered queries against their SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from tracelake.plans import flows, maps, media, more, motion, places, roads, shapes  # noqa: F401
from tracelake.plans.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
SOME = ["a1_index_lines", "a11_assembled_subdatasets", "b16_partition_tables", "b3_points_or_boxes", "c12_union_centroids", "e20_city_outlines", "e20_hotspot_details", "f40_motion_statistics", "g12_analysis_summary", "g27_complete_trajectories", "g29_polygon_validity", "g31_lane_statistics", "g38_lane_availability", "h9_record_lines", "i1_filtered_retrieval", "b7_table_names", "b9_unified_view", "c1_hits_per_box", "c4_analysis_by_type", "c16_join_kinds", "c16_lines_crossing_polygons", "c16_polygon_relations", "d5_points_in_holed_polygons", "g14_lines_meeting_polygons", "g15_lines_in_polygons", "g24_trajectories_in_tolls", "g28_crossings_in_polygons", "d19_polygons_to_trajectories", "g10_all_roads", "g17_input_segments", "h10_segmented_records", "i8_point_sources", "d5_points_in_polygons", "d6_trajectories", "d10_speed_spikes", "e5_density", "e6_hotspots", "e14_redundancy_index", "e16_pareto", "f9_dbscan_clusters", "f13_grid_counters", "f20_adaptive_segments", "f29_segment_distances", "f31_seventeen_features", "f2_segmented_points", "f4_segment_quality", "f26_hausdorff", "f34_direction_entropy", "g5_forward_chains", "g15_lanes_in_boxes", "g16_nearest_lanes", "g19_mean_headings", "h6_merged_labels", "h8_cut_by_ranges", "i1_nearest_vectors", "j2_first_frames"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(frame):
    def value(x):
        if x is None or (isinstance(x, float) and math.isnan(x)):
            return None
        return float(f"{float(x):.6g}") if hasattr(x, "__float__") and not isinstance(x, (bool, str)) else str(x)

    frame = frame[sorted(frame.columns)]
    return sorted(str([value(x) for x in r]) for r in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", SOME)
def test_query(spark, duck, name):
    got, want = QUERIES[name](spark, SF_DIR).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
