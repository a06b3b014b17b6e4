"""Helpers that several operators share: materialising, components, thresholds."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.functions.graph import connected_components, materialize, shared_dir  # noqa: F401

#: ASCII white space separates words everywhere in this package.
WORD = r"[^\x20\x09-\x0D]+"


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of fewer rows than Spark's default: what is made of whole texts is long, and workers keep a batch of it in memory."""
    for batch in batches:
        for at in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(at, rows)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """For applications, not operators: have the session send whole texts to Python in Arrow batches of fewer rows than Spark's default."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, rows)


def split_rows(n: int, target: int) -> int:
    """Blocks of about ``target`` rows that ``n`` rows fill, one at least."""
    return max(1, -(-n // target))


def small(df: DataFrame, few: int = 2_000_000) -> DataFrame:
    """``df`` with a broadcast hint where its rows are counted to be few, else as it is."""
    return F.broadcast(df) if df.count() <= few else df


def without(docs: DataFrame, drop: DataFrame, few: int = 2_000_000) -> DataFrame:
    """Rows of ``docs`` that aren't in ``drop(doc_id)`` or ``drop(doc_id, print)``, where ``print`` is the text's hash.

    What is dropped is broadcast only where its number is known to be small. Null ids match null ids.
    """
    drop = materialize(drop.distinct().withColumnsRenamed({"doc_id": "_id", "print": "_print"}))
    same = docs["doc_id"].eqNullSafe(drop["_id"])
    if "_print" in drop.columns:
        same &= F.xxhash64(docs["text"].cast("string")) == drop["_print"]
    return docs.join(small(drop, few), same, "left_anti")
