"""Stored views, counted upserts and increments rewrite what changed and nothing else."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tracelake.sources import stored, tables


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/*=*/*.parquet")}


def test_refresh_rewrites_changed_parts_only(spark, tmp_path):
    path, made = str(tmp_path / "view"), []

    def make(rows):
        made.append(sorted(r.k for r in rows.select("k").distinct().collect()))
        return rows.select("k", "v", (F.col("v") * 2).alias("twice"))

    frame = lambda rows: spark.createDataFrame(rows, "k string, v int")
    assert stored.refresh_view(frame([("a", 1), ("a", 2), ("b", 3), ("c", 4)]), make, path, "k") == {"rewritten": 3, "removed": 0, "kept": 0}
    before = files(path)
    assert stored.refresh_view(frame([("c", 4), ("a", 2), ("b", 3), ("a", 1)]), make, path, "k") == {"rewritten": 0, "removed": 0, "kept": 3}
    assert files(path) == before and len(made) == 1
    assert stored.refresh_view(frame([("a", 1), ("a", 5), ("b", 3), ("d", None)]), make, path, "k") == {"rewritten": 2, "removed": 1, "kept": 1}
    after = files(path)
    assert {f: t for f, t in after.items() if "k=b" in f} == {f: t for f, t in before.items() if "k=b" in f}
    assert made[-1] == ["a", "d"] and not glob.glob(f"{path}/k=c")
    got = sorted(((r.k, r.v, r.twice) for r in spark.read.parquet(path).collect()), key=str)
    assert got == sorted([("a", 1, 2), ("a", 5, 10), ("b", 3, 6), ("d", None, None)], key=str)


def test_fingerprints_tell_repeated_rows(spark):
    one = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2)], "k string, v int")
    two = spark.createDataFrame([("a", 2), ("a", 1), ("a", 1)], "k string, v int")
    three = spark.createDataFrame([("a", 2), ("a", 2), ("a", 1)], "k string, v int")
    sums = [stored.prints(f, "k").first() for f in (one, two, three)]
    assert sums[0] == sums[1] != sums[2]


def test_upserts_count_occurrences(spark, tmp_path):
    path = str(tmp_path / "roads")
    frame = lambda rows: spark.createDataFrame(rows, "road_id long, analysis string, length double, updated_at int")
    stored.upsert_counts(frame([(k, "x", 1.0, 1) for k in range(50)] + [(3, "x", 2.0, 2), (None, "x", 0.5, 1)]), path, ["road_id", "analysis"], 8)
    before = files(path)
    assert stored.upsert_counts(frame([(3, "x", 9.0, 1), (3, "x", 7.0, 3), (99, "y", 1.0, 1)]), path, ["road_id", "analysis"], 8) <= 2
    kept = [f for f, t in files(path).items() if before.get(f) == t]
    assert len({f.split("part=")[1].split("/")[0] for f in kept}) >= 6
    rows = {(r.road_id, r.analysis): (r.length, r.updated_at, r.occurrence_count) for r in spark.read.parquet(path).collect()}
    assert len(rows) == 52 and rows[3, "x"] == (7.0, 3, 4) and rows[4, "x"] == (1.0, 1, 1) and rows[99, "y"] == (1.0, 1, 1) and rows[None, "x"] == (0.5, 1, 1)


@pytest.fixture
def derby(spark, tmp_path):
    """A database in this process, of the driver that Spark brings along."""
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", str(tmp_path / "derby.log"))
    url = f"jdbc:derby:memory:{tmp_path.name};create=true"
    connection = spark._jvm.org.apache.derby.jdbc.EmbeddedDriver().connect(url, spark._jvm.java.util.Properties())

    def run(sql):
        statement = connection.createStatement()
        statement.executeUpdate(sql)
        statement.close()

    run("CREATE TABLE routes (id INT, name VARCHAR(20), changed INT)")
    run("INSERT INTO routes VALUES " + ", ".join(f"({i}, 'r{i}', {i * 10})" for i in range(1, 21)))
    yield url, run
    connection.close()


def test_foreign_tables_and_migration_by_increments(spark, derby, tmp_path):
    url, run = derby
    options = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    read = tables.read_jdbc(spark, url, "routes", "ID", (1, 21), 4, **options)
    assert read.count() == 20 and read.rdd.getNumPartitions() == 4
    since = stored.read_since(spark, url, "routes", "CHANGED", 150, **options)
    assert since.count() == 5 and "GreaterThan(CHANGED,150)" in since._jdf.queryExecution().toString()
    path = str(tmp_path / "lake")
    assert stored.migrate(spark, url, "routes", path, "CHANGED", **options) == 20
    assert stored.migrate(spark, url, "routes", path, "CHANGED", **options) == 0
    run("INSERT INTO routes VALUES (21, 'new', 500), (22, 'new', 510)")
    before = files(f"{path}/data")
    assert stored.migrate(spark, url, "routes", path, "CHANGED", **options) == 2
    assert before.items() <= files(f"{path}/data").items()
    got = spark.read.parquet(f"{path}/data")
    assert got.count() == 22 and got.select("ID").distinct().count() == 22
