"""Quality-check annotations: cleaning, parsing and cutting trajectories by annotated times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions.text import list_literal, time_ranges


def cleaned(rows: DataFrame, key: str = "autoscene_id") -> DataFrame:
    """Rows with a key, texts trimmed; ``nan``, ``None`` and blank texts become null."""
    for name, kind in rows.dtypes:
        if kind == "string":
            t = F.trim(name)
            rows = rows.withColumn(name, F.when(t.isin("", "nan", "None"), None).otherwise(t))
    return rows.where(F.col(key).isNotNull())


def worth_cutting(rows: DataFrame) -> DataFrame:
    """Rows with a result or another scenario, whose result isn't plainly good."""
    good = F.coalesce(F.col("result").isin("good", "['good']"), F.lit(False))
    return rows.where((F.col("result").isNotNull() | F.col("other_scenario").isNotNull()) & ~good)


def labels(value: Column) -> Column:
    """Array of labels of a list literal, or of a plain text."""
    return F.coalesce(F.when(value.startswith("["), list_literal(value, "string")), F.when(value.isNotNull(), F.array(value)))


def whole_number(value: Column) -> Column:
    """Event ids such as ``12.0`` as integers; null for others."""
    return value.try_cast("double").cast("int")


def unit_of(duration: Column) -> Column:
    """Units a second has, told from a trajectory's duration in them."""
    return F.when(duration < 1e3, 1.0).when(duration < 1e5, 1e3).when(duration < 1e8, 1e6).otherwise(1e9)


def cut_by_ranges(points: DataFrame, ranges: DataFrame, step: float = 0.5, most: float = 5.0) -> DataFrame:
    """Points of each ``(dataset_name, range_no, lo, hi)`` in seconds after the start, with the ``tolerance`` taken.

    The tolerance starts at ``step`` and grows by it up to the lesser of ``most`` and a tenth of the
    duration; the first that gives two points or more wins. Ranges before the start or after the end,
    and those of trajectories under five seconds, give nothing.
    """
    w = Window.partitionBy("dataset_name")
    timed = points.withColumns({"first": F.min("ts").over(w), "duration": F.max("ts").over(w) - F.min("ts").over(w)})
    timed = timed.withColumns({"unit": unit_of(F.col("duration"))}).withColumns({"at": (F.col("ts") - F.col("first")) / F.col("unit"), "length": F.col("duration") / F.col("unit")})
    met = timed.join(ranges, "dataset_name").where("hi >= 0 and lo <= length")
    # the least multiple of step that reaches the point, the first allowed one at least
    away = F.greatest(F.col("lo") - F.col("at"), F.col("at") - F.col("hi"), F.lit(0.0))
    need = F.greatest(F.lit(step), F.ceil(away / step) * step)
    met = met.withColumn("need", need).where(F.col("need") <= F.least(F.lit(most), 0.1 * F.col("length")))
    per = Window.partitionBy("dataset_name", "range_no")
    # two points are there from the second smallest need on
    met = met.withColumn("nth", F.row_number().over(per.orderBy("need", "ts"))).withColumn("tolerance", F.max(F.when(F.col("nth") == 2, F.col("need"))).over(per))
    return met.where(F.col("need") <= F.col("tolerance")).drop("first", "duration", "unit", "length", "need", "nth")


def ranges_of(records: DataFrame, *keys: str) -> DataFrame:
    """A row for each valid range of ``records(dataset_name, description)``, with further ``keys``."""
    rows = records.select("dataset_name", *keys, F.posexplode(time_ranges(F.col("description"))).alias("range_no", "r"))
    return rows.select("dataset_name", *keys, "range_no", F.get("r", F.lit(0)).alias("lo"), F.get("r", F.lit(1)).alias("hi"))
