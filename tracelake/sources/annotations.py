"""Quality-check annotations from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracelake.operators.quality_check import cleaned

REQUIRED = ("task_name", "annotator", "autoscene_id", "result", "description", "other_scenario")


def read_annotations(spark: SparkSession, *paths: str, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Cleaned records of CSV (with header), JSON-lines or parquet files, all read as texts; a file without a required column is an error."""
    out = None
    for path in paths:
        end = path.rstrip("/").rsplit(".", 1)[-1]
        reader = {"parquet": spark.read.parquet, "json": spark.read.json, "jsonl": spark.read.json}.get(end)
        rows = reader(path) if reader else spark.read.csv(path, header=True, multiLine=True, escape='"')
        missing = [c for c in required if c not in rows.columns]
        if missing:
            raise ValueError(f"{path} lacks {', '.join(missing)}")
        rows = cleaned(rows.select(*[rows[c].cast("string").alias(c) for c in required]))
        out = rows if out is None else out.unionByName(rows)
    return out
