"""Scene datasets on disk: index files, training JSON, defect lists, nested JSON and flat parquet."""

from __future__ import annotations

import base64
import gzip
import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.functions.text import subdataset_name
from tracelake.operators.datasets import defect_lines, parse_index


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``(path, factor, subdataset_name)`` of an index file's valid lines."""
    return parse_index(spark.read.text(path))


def decoded_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """JSON text of lines that hold JSON, or gzipped JSON in base64; null for others. Pickled lines are refused."""

    def decode(line: str | None) -> str | None:
        line = (line or "").strip()
        try:
            text = line if line[:1] in ("{", "[") else gzip.decompress(base64.b64decode(line, validate=True)).decode()
            json.loads(text)
            return text
        except (ValueError, OSError, EOFError):
            return None

    def run(frames):
        for f in frames:
            yield pd.DataFrame({"json": [decode(x) for x in f[col]]})

    return lines.select(col).mapInPandas(run, "json string")


def read_scenes(spark: SparkSession, index: str) -> DataFrame:
    """Scenes of all files that an index lists: ``(subdataset_name, obs_path, duplication_factor, scene_id)``.

    Files are read together; the file name tells a scene's sub-dataset.
    """
    listed = read_index(spark, index).select(F.col("path").alias("obs_path"), F.col("factor").alias("duplication_factor"), "subdataset_name")
    paths = [r[0] for r in listed.select("obs_path").distinct().collect()]  # an index is a short list of files
    if not paths:
        return spark.createDataFrame([], "subdataset_name string, obs_path string, duplication_factor int, scene_id string")
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"))

    def run(frames):
        for f in frames:
            out = []
            for value, file in zip(f["value"], f["file"], strict=True):
                v = (value or "").strip()
                try:
                    v = v if v[:1] == "{" else gzip.decompress(base64.b64decode(v, validate=True)).decode()
                    scene = json.loads(v).get("scene_id")
                except (ValueError, OSError, EOFError, AttributeError):
                    scene = None
                if scene is not None:
                    out.append((file, str(scene)))
            yield pd.DataFrame(out, columns=["file", "scene_id"])

    scenes = lines.mapInPandas(run, "file string, scene_id string")
    ends = F.regexp_replace(F.regexp_replace("file", "^[a-z]+:/+", "/"), "^/+", "/") == F.regexp_replace(F.regexp_replace("obs_path", "^[a-z]+:/+", "/"), "^/+", "/")
    few = len(paths) <= 100_000
    return scenes.join(F.broadcast(listed) if few else listed, ends).select("subdataset_name", "obs_path", "duplication_factor", "scene_id")


def read_training_json(spark: SparkSession, path: str) -> DataFrame:
    """``(dataset_name, subdataset_name, obs_path, duplication_factor)`` of a training JSON; items without name or path are left out."""
    schema = "meta struct<release_name:string,consumer_version:string,description:string,bundle_versions:array<string>>, name string, dataset_index array<struct<name:string,obs_path:string,bundle_versions:array<string>,duplicate:int>>"
    doc = spark.read.schema(schema).json(path, multiLine=True)
    items = doc.select(F.coalesce("meta.release_name", "name", F.lit("unnamed")).alias("dataset_name"), F.explode("dataset_index").alias("i"))
    return items.where("i.name is not null and i.obs_path is not null").select("dataset_name", F.col("i.name").alias("subdataset_name"), F.col("i.obs_path").alias("obs_path"), F.coalesce("i.duplicate", F.lit(1)).alias("duplication_factor"))


def read_defects(spark: SparkSession, path: str) -> DataFrame:
    return defect_lines(spark.read.text(path))


def read_ids(spark: SparkSession, path: str, column: str = "scene_id") -> DataFrame:
    """Distinct scene ids of a parquet, JSON or text file; blank lines and those that start with # are left out."""
    if path.rstrip("/").endswith(".parquet"):
        ids = spark.read.parquet(path).select(column)
    elif path.endswith(".json"):
        ids = spark.read.json(path, multiLine=True).select(F.explode("subdatasets").alias("s")).select(F.explode("s.scene_ids").alias(column))
    else:
        ids = spark.read.text(path).select(F.trim("value").alias(column)).where(f"{column} <> '' and not {column} like '#%'")
    return ids.distinct()


def side_car(path: str) -> str:
    """Name of the file beside a flat dataset that describes it."""
    return path.rstrip("/").removesuffix(".parquet") + ".meta.json"


def write_dataset(items: DataFrame, path: str, kind: str = "parquet", meta: dict | None = None) -> None:
    """Flat parquet, or one JSON document for each sub-dataset.

    Beside a flat dataset a side-car (``.meta.json``) holds ``meta`` (name, description, created_at, metadata) with
    ``total_unique_scenes`` and ``total_scenes``, in which duplicates count. A flat dataset of no rows is an error.
    """
    if kind == "parquet":
        items.write.mode("overwrite").parquet(path, compression="snappy")
        spark = items.sparkSession
        factor = F.coalesce("duplication_factor", F.lit(1)) if "duplication_factor" in items.columns else F.lit(1)
        totals = spark.read.schema(items.schema).parquet(path).agg(F.count("*").alias("n"), F.sum(factor).alias("all")).first()
        if not totals["n"]:
            raise ValueError("a dataset without scenes can't be written as parquet")
        text = json.dumps({**(meta or {}), "total_unique_scenes": totals["n"], "total_scenes": totals["all"]}, ensure_ascii=False, indent=2)
        jvm = spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(side_car(path))
        out = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place, True)
        out.write(bytearray(text.encode()))
        out.close()
    else:
        nested = items.groupBy(F.col("subdataset_name").alias("name"), "obs_path", "duplication_factor").agg(F.array_sort(F.collect_list("scene_id")).alias("scene_ids"))
        nested.write.mode("overwrite").json(path)


def read_meta(spark: SparkSession, path: str) -> dict:
    """What a flat dataset's side-car says; one small file."""
    return json.loads(spark.read.text(side_car(path), wholetext=True).first()[0])


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Sub-datasets of a flat parquet dataset with their scenes and the first row's metadata."""
    flat = spark.read.parquet(path)
    metadata = F.first("metadata", ignorenulls=True) if "metadata" in flat.columns else F.lit(None).cast("string")
    return flat.groupBy("subdataset_name", "obs_path", "duplication_factor").agg(F.array_sort(F.collect_list("scene_id")).alias("scene_ids"), metadata.alias("metadata"))


def named(items: DataFrame) -> DataFrame:
    return items.withColumn("subdataset_name", F.coalesce("subdataset_name", subdataset_name(F.col("obs_path"))))
