"""Stored results that are brought up to date by parts: views, counted upserts, increments of foreign tables.

All are folders of parquet with one folder for each value of a partition column. A part is rewritten whole by
Spark's dynamic overwrite, and only after that is it noted as done, so that a run that was cut short is taken up
by the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.functions.graph import materialize

NOTES = "_manifest"  # beside the parts; Spark's readers pass over names that begin so
MARK = "_mark"


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def drop_folder(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def overwrite_parts(rows: DataFrame, path: str, by: str) -> None:
    """Write ``rows`` to the folders of their values of ``by``; other folders stay as they are."""
    rows.repartition(by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def prints(source: DataFrame, by: str) -> DataFrame:
    """``(by, rows, sum, mix)``: a fingerprint of each part, whatever the order of its rows; sums wrap nowhere."""
    h = F.xxhash64(*[F.col(c).cast("string") if t.startswith(("map", "struct", "array")) else F.col(c) for c, t in source.dtypes])
    return source.groupBy(by).agg(F.count("*").alias("rows"), F.sum(h.cast("decimal(38,0)")).alias("sum"), F.bit_xor(h).alias("mix"))


def refresh_view(source: DataFrame, make: Callable[[DataFrame], DataFrame], path: str, by: str) -> dict[str, int]:
    """Bring the stored view ``make(source)`` below ``path`` up to date; returns how many parts were rewritten, removed and kept.

    ``make`` works on each part of ``source`` by itself and keeps the column ``by``, which isn't null. Parts whose fingerprint
    is in the manifest are neither read again by ``make`` nor written; parts that ``source`` has no more are removed.
    The first call creates the view.
    """
    spark = source.sparkSession
    new = materialize(prints(source, by))
    old = materialize(spark.read.parquet(f"{path}/{NOTES}")) if exists(spark, f"{path}/{NOTES}") else new.limit(0)
    same = new.join(old, [by, "rows", "sum", "mix"], "left_semi")
    changed = materialize(new.join(same, by, "left_anti").select(by))
    gone = [r[0] for r in old.join(new, by, "left_anti").select(F.col(by).cast("string")).collect()]  # names of folders
    if not changed.isEmpty():
        overwrite_parts(make(source.join(changed, by, "left_semi")), path, by)
    for name in gone:
        drop_folder(spark, f"{path}/{by}={name}")
    new.coalesce(1).write.mode("overwrite").parquet(f"{path}/{NOTES}")
    n = changed.count()
    return {"rewritten": n, "removed": len(gone), "kept": new.count() - n}


def upsert_counts(rows: DataFrame, path: str, keys: list[str], parts: int = 64) -> int:
    """Add ``rows`` to the stored table of distinct ``keys``; returns how many parts were rewritten.

    The table has the other columns of the last row of each key (by ``updated_at``; ties by the other columns) and
    ``occurrence_count``, how many rows of the key have ever come. Null keys are keys. Only parts (``part``, by hash of the
    keys) that new rows fall in are read and rewritten.
    """
    spark = rows.sparkSession
    rest = [c for c in rows.columns if c not in keys]
    new = rows.withColumns({"part": F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"), "occurrence_count": F.lit(1).cast("long")})
    touched = materialize(new.select("part").distinct())
    if exists(spark, path):
        new = new.unionByName(spark.read.parquet(path).join(F.broadcast(touched), "part", "left_semi"))
    last = F.max(F.struct("updated_at", *[c for c in rest if c != "updated_at"])).alias("last")
    merged = new.groupBy(*keys, "part").agg(last, F.sum("occurrence_count").alias("occurrence_count"))
    merged = materialize(merged.select(*keys, *[F.col("last")[c].alias(c) for c in rest], "occurrence_count", "part"))  # read before it is overwritten
    overwrite_parts(merged, path, "part")
    return touched.count()


def read_since(spark: SparkSession, url: str, table: str, column: str, after, **options: str) -> DataFrame:
    """Rows of a foreign table whose ``column`` lies beyond ``after`` (all rows without it); the other side filters."""
    frame = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return frame if after is None else frame.where(F.col(column) > F.lit(after))


def migrate(spark: SparkSession, url: str, table: str, path: str, column: str, part: Column | None = None, **options: str) -> int:
    """Append what a foreign table has beyond the mark of the last run to ``path/data``; returns how many rows came.

    The mark is the largest value of ``column`` that was stored, kept beside the data. Each run writes a folder of its own,
    named by the marks it starts from, so that a run that was cut short before it moved the mark overwrites its rows.
    """
    marks = f"{path}/{MARK}"
    after = spark.read.parquet(marks).first()["mark"] if exists(spark, marks) else None
    rows = read_since(spark, url, table, column, after, **options)
    rows = rows if part is None else rows.withColumn("part", part)
    run = "first" if after is None else F.lit(str(after)).cast("string")
    rows = materialize(rows.withColumn("run", F.lit(run) if isinstance(run, str) else run))
    most = rows.agg(F.max(column).alias("mark"), F.count("*").alias("n")).first()
    if most["n"]:
        overwrite_parts(rows, f"{path}/data", "run")
        rows.agg(F.max(column).alias("mark")).write.mode("overwrite").parquet(marks)
    return most["n"]
