"""Image frames and routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions.text import image_format

#: Column names that hold a frame's image, time and file name, first found wins (fixed values).
IMAGE, TIME, NAME = ("image", "img_data", "image_data", "data"), ("timestamp", "time", "ts"), ("filename", "name", "file")


def frames(rows: DataFrame, scene: str = "scene_id", most: int | None = None, wanted: list[int] | None = None) -> DataFrame:
    """Frames of each scene in the order of time, numbered from 0, with their format; ``wanted`` numbers or the first ``most``."""
    find = lambda names: next((c for c in names if c in rows.columns), None)
    image, time, name = find(IMAGE), find(TIME), find(NAME)
    if image is None:
        raise ValueError("no image column")
    out = rows.select(scene, F.col(image).alias("image_data"), (F.col(time) if time else F.lit(0)).alias("timestamp"), (F.col(name) if name else F.lit(None).cast("string")).alias("filename"))
    out = out.withColumn("frame_index", F.row_number().over(Window.partitionBy(scene).orderBy("timestamp", "filename")) - 1).withColumn("image_format", image_format(F.col("image_data")))
    if wanted is not None:
        return out.where(F.col("frame_index").isin(wanted))
    return out if most is None else out.where(F.col("frame_index") < most)


def report(found: DataFrame, scene: str = "scene_id") -> DataFrame:
    """One HTML fragment for each scene, its images inline."""
    tag = F.concat(F.lit('<img alt="'), F.coalesce("filename", F.lit("")), F.lit('" src="data:image/'), "image_format", F.lit(";base64,"), F.base64("image_data"), F.lit('"/>'))
    tags = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("frame_index", tag.alias("tag")))), lambda x: x["tag"]), "\n")
    return found.groupBy(scene).agg(F.concat(F.lit("<h2>"), F.first(scene), F.lit("</h2>\n"), tags).alias("html"))


def route_id(url: Column) -> Column:
    """Last part of the path of a map service's URL; null for other hosts."""
    return F.when(F.try_parse_url(url, F.lit("HOST")).contains("amap.com"), F.nullif(F.element_at(F.split(F.trim(F.try_parse_url(url, F.lit("PATH")), F.lit("/")), "/"), -1), F.lit("")))


def coordinates(url: Column, name: str) -> Column:
    """``struct<lon,lat>`` of a query parameter ``lon,lat``."""
    parts = F.split(F.try_parse_url(url, F.lit("QUERY"), F.lit(name)), ",")
    return F.struct(F.get(parts, F.lit(0)).try_cast("double").alias("lon"), F.get(parts, F.lit(1)).try_cast("double").alias("lat"))


def polyline(text: Column) -> Column:
    """Array of ``struct<lon,lat>`` of ``lon,lat;lon,lat``; malformed pairs are left out."""
    pair = lambda s: F.struct(F.get(F.split(s, ","), F.lit(0)).try_cast("double").alias("lon"), F.get(F.split(s, ","), F.lit(1)).try_cast("double").alias("lat"))
    return F.filter(F.transform(F.split(text, ";"), pair), lambda p: p["lon"].isNotNull() & p["lat"].isNotNull())


def shown_time(t: Column) -> Column:
    """Text of a time in microseconds (beyond 1e12 times a hundred) or milliseconds."""
    return F.date_format(F.when(t > 10**14, F.timestamp_micros(t)).otherwise(F.timestamp_millis(t)), "yyyy-MM-dd HH:mm:ss")


def assembled(steps: DataFrame, route: str, order: str) -> DataFrame:
    """One route from its steps' polylines, in order."""
    return steps.groupBy(route).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order, polyline(F.col("polyline")).alias("path")))), lambda x: x["path"])).alias("path"), F.sum("distance").alias("distance"))
