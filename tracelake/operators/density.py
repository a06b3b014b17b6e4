"""Grid density, hotspots, redundancy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.operators.boxes import box_join, cells

CELL = 0.002
THRESHOLD = 5


def density(boxes: DataFrame, size: float = CELL, least: int = THRESHOLD, area: bool = False) -> DataFrame:
    """Cells of each city that ``least`` good boxes or more cover, with counts, members and envelope."""
    weight = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")) if area else F.lit(1.0)
    covered = cells(boxes.where("all_good"), size).groupBy("city_id", F.col("gx").alias("grid_x"), F.col("gy").alias("grid_y"))
    out = covered.agg(
        F.count("*").alias("bbox_count"), F.countDistinct("subdataset_name").alias("subdataset_count"), F.countDistinct("scene_token").alias("scene_count"),
        F.array_sort(F.collect_set("subdataset_name")).alias("involved_subdatasets"), F.array_sort(F.collect_set("scene_token")).alias("involved_scenes"), F.sum(weight).alias("total_bbox_area"),
    )
    return out.where(F.col("bbox_count") >= least)


def ranked(cells_: DataFrame, *by: str) -> DataFrame:
    """Rank by density in each group (all cells without ``by``); ties by place. A city's cells are far fewer than its boxes."""
    order = Window.partitionBy(*by).orderBy(F.desc("bbox_count"), "grid_x", "grid_y") if by else Window.partitionBy().orderBy(F.desc("bbox_count"), "city_id", "grid_x", "grid_y")
    return cells_.withColumn("hot_rank", F.row_number().over(order))


def top_share(cells_: DataFrame, percent: float, rule: str = "round", by: tuple[str, ...] = ("city_id",)) -> DataFrame:
    """The densest ``percent`` of each group's cells, one at least; the share's size is rounded, or cut (rule ``int``)."""
    n = F.count("*").over(Window.partitionBy(*by)) * F.lit(percent / 100)
    size = F.round(n) if rule == "round" else F.floor(n)
    return ranked(cells_, *by).withColumn("n", F.greatest(F.lit(1), size.cast("int"))).where("hot_rank <= n").drop("n")


def banded(n: Column) -> Column:
    """Estimate of the time that a city's analysis takes."""
    return F.when(n > 50000, "> 10分钟").when(n > 10000, "2-10分钟").when(n > 1000, "< 2分钟").otherwise("< 30秒")


def recommended(good: Column, total: Column) -> Column:
    """How well a city suits an analysis (fixed texts)."""
    share = good * 100.0 / total
    return (
        F.when(good.between(1000, 20000) & (share > 90), "⭐⭐⭐ 推荐")
        .when(good.between(500, 50000) & (share > 85), "⭐⭐ 较好")
        .when(good > 100, "⭐ 可用")
        .otherwise("❌ 不建议")
    )


def city_quality(boxes: DataFrame) -> DataFrame:
    good = F.count_if("all_good")
    return boxes.groupBy("city_id").agg(F.count("*").alias("total_count"), good.alias("good_count"), F.round(good * 100.0 / F.count("*"), 1).alias("good_percent")).where("good_count > 0")


def coverage(top: DataFrame, boxes: DataFrame, size: float = CELL) -> DataFrame:
    """Boxes that touch each city's top cells: rows (a box counts in every cell it touches) and distinct scenes."""
    areas = top.select(F.col("city_id"), (F.col("grid_x") * size).alias("xmin"), (F.col("grid_y") * size).alias("ymin"), ((F.col("grid_x") + 1) * size).alias("xmax"), ((F.col("grid_y") + 1) * size).alias("ymax"))
    met = box_join(areas, boxes.where("all_good"), size).where("l_city_id = r_city_id")
    return met.groupBy(F.col("l_city_id").alias("city_id")).agg(F.count("*").alias("covered_rows"), F.countDistinct("r_scene_token").alias("covered_scenes"))


def redundancy(cells_: DataFrame, percent: float) -> DataFrame:
    """Share of boxes in the densest cells over the share of cells."""
    w = Window.partitionBy("city_id")
    marked = ranked(cells_, "city_id").withColumn("n", F.count("*").over(w)).withColumn("top", F.col("hot_rank") <= F.greatest(F.lit(1), F.round(F.col("n") * percent / 100)))
    sums = marked.groupBy("city_id").agg(F.sum("bbox_count").alias("all_boxes"), F.sum(F.when(F.col("top"), F.col("bbox_count")).otherwise(0)).alias("top_boxes"), F.count("*").alias("cells"), F.count_if("top").alias("top_cells"))
    return sums.withColumn("redundancy_index", F.round((F.col("top_boxes") / F.col("all_boxes")) / (F.col("top_cells") / F.col("cells")), 2))


def pareto(cells_: DataFrame) -> DataFrame:
    """Cells from the densest down with the cumulative share of boxes and of cells, by city."""
    w = Window.partitionBy("city_id")
    run = w.orderBy("hot_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranked(cells_, "city_id").select(
        "city_id", "grid_x", "grid_y", "hot_rank",
        F.round(F.sum("bbox_count").over(run) * 100.0 / F.sum("bbox_count").over(w), 4).alias("box_percent"), F.round(F.col("hot_rank") * 100.0 / F.count("*").over(w), 4).alias("cell_percent"),
    )


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new``, and those of ``old`` whose keys it lacks."""
    return new.unionByName(old.join(new, keys, "left_anti"))


def density_level(n: Column) -> Column:
    return F.when(n >= 20, "Very High Density").when(n >= 10, "High Density").when(n >= 5, "Medium Density").when(n >= 2, "Low Density").otherwise("Single Overlap")


def area_level(area: Column) -> Column:
    return F.when(area >= 0.01, "Large Area").when(area >= 0.001, "Medium Area").otherwise("Small Area")


def hotspot_score(n: Column, area: Column) -> Column:
    return n * 0.7 + F.log10(1 + area * 10000) * 0.3


def severity(index: Column) -> Column:
    return F.when(index >= 20, "severe").when(index >= 10, "moderate").otherwise("normal")
