"""Live extents, density and events from a stream of points; checkpoints take the place of resume files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tracelake.operators.boxes import cells, extents


def live_extents(points: DataFrame) -> DataFrame:
    """Extent of each trajectory so far (update or complete mode)."""
    return extents(points, "dataset_name")


def windowed_density(points: DataFrame, time: str, size: float = 0.002, window: str = "10 minutes", late: str = "5 minutes") -> DataFrame:
    """Points by cell and window of event time; points later than ``late`` are dropped by the watermark."""
    boxed = points.withWatermark(time, late).withColumns({"xmin": F.col("lon"), "xmax": F.col("lon"), "ymin": F.col("lat"), "ymax": F.col("lat")})
    return cells(boxed, size).groupBy(F.window(time, window), "gx", "gy").agg(F.count("*").alias("points"))


def sessions(points: DataFrame, time: str, gap: str = "3 seconds", late: str = "1 minute") -> DataFrame:
    """Runs of points of a trajectory with no gap over ``gap``."""
    return points.withWatermark(time, late).groupBy("dataset_name", F.session_window(time, gap).alias("run")).agg(F.count("*").alias("points"))


def upserting(stream: DataFrame, path: str, checkpoint: str, keys: list[str]) -> DataStreamWriter:
    """Writer that keeps the last row of each key of every batch below ``path/batch_id``: a batch that runs again overwrites itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates(keys).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
