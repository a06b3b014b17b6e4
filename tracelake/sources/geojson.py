"""GeoJSON polygons and lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINT = "array<double>"


def features(spark: SparkSession, path: str) -> DataFrame:
    """``(position, type, coordinates, properties)`` of a FeatureCollection, a feature or a bare geometry; coordinates stay JSON."""
    text = spark.read.text(path, wholetext=True).select(F.col("value").alias("doc"))
    kind = F.get_json_object("doc", "$.type")
    many = F.from_json(F.get_json_object("doc", "$.features"), "array<string>")
    each = F.when(kind == "FeatureCollection", many).when(kind == "Feature", F.array("doc")).otherwise(F.array(F.concat(F.lit('{"geometry":'), "doc", F.lit(',"properties":{}}'))))
    rows = text.select(F.posexplode(each).alias("position", "f"))
    return rows.select(
        "position", F.get_json_object("f", "$.geometry.type").alias("type"), F.get_json_object("f", "$.geometry.coordinates").alias("coordinates"), F.from_json(F.get_json_object("f", "$.properties"), "map<string,string>").alias("properties")
    )


def read_polygons(spark: SparkSession, path: str) -> DataFrame:
    """``(polygon_id, rings, properties)``, holes included, as ``operators.polygons`` takes them; a MultiPolygon gives a row for each part."""
    f = features(spark, path)
    one = F.from_json("coordinates", f"array<array<{POINT}>>")
    more = F.from_json("coordinates", f"array<array<array<{POINT}>>>")
    parts = F.when(F.col("type") == "Polygon", F.array(one)).when(F.col("type") == "MultiPolygon", more)
    rows = f.where(F.col("type").isin("Polygon", "MultiPolygon")).select("position", "properties", F.posexplode(parts).alias("part", "rings"))
    name = F.coalesce(F.col("properties")["id"], F.col("properties")["polygon_id"], F.concat(F.lit("polygon_"), "position"))
    place = lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))
    # a closing corner equal to the first adds nothing
    opened = lambda r: F.when((F.size(r) > 1) & (F.get(r, F.lit(0)) == F.element_at(r, -1)), F.slice(r, 1, F.greatest(F.size(r) - 1, F.lit(1)))).otherwise(r)
    rings = F.transform("rings", lambda r: opened(F.transform(r, place)))
    return rows.select(F.when(F.col("part") > 0, F.concat(name, F.lit("_"), "part")).otherwise(name).alias("polygon_id"), rings.alias("rings"), "properties")


def read_lines(spark: SparkSession, path: str, required: tuple[str, ...] = ("scene_id", "data_name")) -> DataFrame:
    """``(properties' required fields, line)`` of LineStrings of two points or more that have them all."""
    f = features(spark, path).where("type = 'LineString'")
    line = F.transform(F.from_json("coordinates", f"array<{POINT}>"), lambda p: F.struct(F.get(p, F.lit(0)).alias("lon"), F.get(p, F.lit(1)).alias("lat")))
    rows = f.select(*[F.col("properties")[c].alias(c) for c in required], line.alias("line")).where("size(line) >= 2")
    return rows.dropna(subset=list(required))


def write_lines(rows: DataFrame, path: str) -> None:
    """A GeoJSON feature a line of text, from rows with ``line`` (points, or several lines of them); other columns become properties, lists joined by commas."""
    kinds = dict(rows.dtypes)
    pairs = lambda line: F.transform(line, lambda p: F.array(p["lon"], p["lat"]))
    many = kinds["line"].startswith("array<array<")
    joined = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c) if kinds[c].startswith("array<") else F.col(c)
    properties = F.struct(*[joined(c) for c in rows.columns if c != "line"])
    coordinates = F.transform("line", pairs) if many else pairs("line")
    geometry = F.struct(F.lit("MultiLineString" if many else "LineString").alias("type"), coordinates.alias("coordinates"))
    rows.select(F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), properties.alias("properties"))).alias("value")).write.mode("overwrite").text(path)
