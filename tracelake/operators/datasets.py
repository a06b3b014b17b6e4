"""Scene datasets: index lines, assembly, duplication, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.functions.text import attributes, index_line, subdataset_name, url_parameter


def parse_index(lines: DataFrame, col: str = "value") -> DataFrame:
    """``(path, factor, subdataset_name)`` of valid index lines."""
    return lines.select(index_line(F.col(col)).alias("x")).where("x is not null").select("x.path", "x.factor", subdataset_name(F.col("x.path")).alias("subdataset_name"))


def assemble(items: DataFrame) -> DataFrame:
    """Sub-datasets of ``(subdataset_name, obs_path, duplication_factor, scene_id)`` with their scenes and totals."""
    return items.where(F.col("scene_id").isNotNull()).groupBy("subdataset_name", "duplication_factor").agg(
        F.count("*").alias("scene_count"), (F.count("*") * F.first("duplication_factor")).alias("total_count"), F.array_sort(F.collect_list("scene_id")).alias("scene_ids")
    )


def stats(items: DataFrame) -> DataFrame:
    return items.groupBy("subdataset_name").agg(
        F.count("*").alias("unique_scenes"), F.min("duplication_factor").alias("min_factor"), F.sum("duplication_factor").alias("total_scenes")
    )


def matching(items: DataFrame, **filters) -> DataFrame:
    """Rows equal to every filter on a column that exists; unknown names are ignored."""
    for name, value in filters.items():
        if name in items.columns:
            items = items.where(F.col(name) == value)
    return items


def duplicated(items: DataFrame, factor: str = "duplication_factor") -> DataFrame:
    """A row for each duplicate, numbered by ``duplicate_index`` from 0."""
    return items.where(F.col(factor) > 0).withColumn("duplicate_index", F.explode(F.sequence(F.lit(0), F.col(factor).cast("int") - 1)))


def defect_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """``(data_name, attributes)`` of lines ``url|k=v|flag`` whose URL names data."""
    out = lines.select(url_parameter(F.substring_index(F.col(col), "|", 1), "dataName").alias("data_name"), attributes(F.col(col)).alias("attributes"))
    return out.where("data_name is not null")


def two_hops(names: DataFrame, first: DataFrame, second: DataFrame, name: str, link: str, target: str) -> DataFrame:
    """``names`` with ``target``, looked up through ``first(name, link)`` and ``second(link, target)``; null where either misses."""
    return names.join(first.dropDuplicates([name]), name, "left").join(second.dropDuplicates([link]), link, "left").select(*names.columns, target)


def remaining(everything: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return everything.join(done, key, "left_anti")


def retryable(failed: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return failed.select(key).distinct().join(done, key, "left_anti")


def latest(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key by ``order``."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def with_fallback(main: DataFrame, other: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows of ``main`` for wanted keys, and rows of ``other`` for those that main lacks."""
    found = main.join(wanted, key, "left_semi")
    return found.unionByName(other.join(wanted, key, "left_semi").join(found, key, "left_anti"))


#: Names of partition tables begin so; those with any of these words in them are none (fixed values).
PART_PREFIX, NO_PARTS = "clips_bbox_", ("unified", "temp", "backup", "test", "tmp")


def partition_tables(names: DataFrame, rows: DataFrame | None = None, view: str | None = None) -> DataFrame:
    """Of ``names(table_name)`` those of partition tables: by prefix, without reserved words, the view itself and, with ``rows(table_name, data_type)``, tables that hold defects."""
    name = F.col("table_name")
    found = names.where(name.startswith(PART_PREFIX)).where(~F.lower(name).rlike("|".join(NO_PARTS)))
    if view:
        found = found.where(name != view)
    if rows is not None:
        found = found.join(rows.where("data_type = 'defect'").select("table_name").distinct(), "table_name", "left_anti")
    return found.select("table_name").distinct()
