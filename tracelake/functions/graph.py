"""Tables in the shared folder, joins without broadcasts, and connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The application's folder below the one all executors share, ``spark.checkpoint.dir``.

    Only a session on one machine may leave that unset; a temporary folder is then set. On a cluster that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return f"{path.rstrip('/')}/{spark.sparkContext.applicationId}"


def drop_tables(spark: SparkSession) -> None:
    """Delete what this application has materialised; call it when its results are read."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """``df``, not to be broadcast when it is joined: tables that grow with the input are small in files, where Spark measures them, and large in the driver, which builds what is broadcast."""
    return df.hint("merge")


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every id in ``edges(src, dst)``; component = smallest reachable id.

    Large-star and small-star rounds: each is one aggregation by node and one join, both with
    map-side partial results, so that a hub with very many neighbours isn't gathered in one place.
    The number of rounds grows with the logarithm of the longest chain. Self loops and repeated
    edges do no harm; no edges give no rows.
    """
    e = materialize(
        edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u is not null and v is not null").distinct()
    )
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large-star: larger neighbours of u hang on the smallest of u's neighbourhood
        large = both.where("v > u").join(shuffled(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # small-star: smaller neighbours of u, and u itself, hang on the smallest of them
        small = large.join(shuffled(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        # done when all edges form stars: one parent each, no parent with a parent
        single = e.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
        if single and e.join(shuffled(e.select(F.col("v").alias("u")).distinct()), "u", "left_semi").isEmpty():
            break
    return e.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
