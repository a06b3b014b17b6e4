"""Other tables: JDBC sources and partitioned sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.functions.text import table_name


def read_jdbc(spark: SparkSession, url: str, table: str, column: str | None = None, bounds: tuple[int, int] = (0, 0), partitions: int = 1, **options: str) -> DataFrame:
    """A foreign table; with ``column`` it is read in parallel ranges."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if column:
        reader = reader.options(partitionColumn=column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions)
    return reader.load()


def write_boxes(boxes: DataFrame, path: str) -> None:
    """Boxes by sub-dataset: one folder each, under the normal table name."""
    boxes.withColumn("source_table", table_name(F.col("subdataset_name"))).write.mode("overwrite").partitionBy("source_table").parquet(path)
