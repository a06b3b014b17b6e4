"""Retrieval: nearest vectors by pivots and rings, quotas, windows of time, similarity statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions.graph import materialize

HALF_DAY_MS = 12 * 3600 * 1000


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of doubles; null if either is zero."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


PIVOTS, RINGS = 16, 64  # vectors that all others are placed by, and rings around each, 2 / RINGS wide
SLACK = 1e-9  # by which distances may be off
SINGLE, TOTAL = 10_000, 100_000  # results of one call, and of all calls of a quota


class Quota:
    """How many results may still be asked for; asking for more is an error."""

    def __init__(self, single: int = SINGLE, total: int = TOTAL):
        self.single, self.total, self.used = single, total, 0

    def take(self, count: int) -> None:
        if count > self.single:
            raise ValueError(f"{count} results in one call; {self.single} at most")
        if self.used + count > self.total:
            raise ValueError(f"{count} more results; {self.total - self.used} of {self.total} are left")
        self.used += count


def usable(v: Column) -> Column:
    """Vectors that have a direction: no nulls or infinities in them, and not zero."""
    return v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)


def unit(v: Column) -> Column:
    size = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(v, lambda x: x / size)


def apart(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def placed(vectors: DataFrame, pivots: DataFrame) -> DataFrame:
    """``vectors(u, ...)`` with ``cell``, the number of the nearest of ``pivots``, one row with an array of unit vectors, and ``ring``, how far it is."""
    away = F.transform("pivots", lambda p: apart(p, F.col("u")))
    near = vectors.crossJoin(F.broadcast(pivots)).withColumn("away", away).drop("pivots")
    ring = F.least(F.floor(F.array_min("away") * (RINGS / 2)), F.lit(RINGS)).cast("int")
    return near.withColumns({"cell": F.array_position("away", F.array_min("away")).cast("int") - 1, "ring": ring}).drop("away")


def nearest(vectors: DataFrame, queries: DataFrame, k: int, start: int | None = None, stop: int | None = None, datasets: list[str] | None = None, quota: Quota | None = None) -> DataFrame:
    """The ``k`` vectors of largest cosine for each of any number of queries ``(query_id, q)``: ``query_id, vec_id, similarity, nth``.

    ``start`` and ``stop`` bound ``timestamp_ms``, ``datasets`` the names, where given; ``quota`` counts ``k`` results. Exact: vectors
    lie in rings around pivots, and by the triangle inequality a ring tells how near its vectors can be to a query and how
    far. The rings that must hold ``k`` vectors are scored first; of the others only those that can come nearer than the
    k-th of these. Queries travel to rings, not to all vectors. Ties go to smaller ids; null, zero and non-finite vectors,
    and queries of that kind, take no part.
    """
    if quota:
        quota.take(k)
    for test in ([F.col("timestamp_ms") >= start] if start is not None else []) + ([F.col("timestamp_ms") <= stop] if stop is not None else []) + ([F.col("dataset_name").isin(datasets)] if datasets else []):
        vectors = vectors.where(test)
    raw = F.col("embedding").cast("array<double>")
    units = vectors.where(usable(raw)).select("vec_id", raw.alias("v")).withColumn("u", unit(F.col("v")))
    first = units.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS)  # a fixed number
    pivots = materialize(first.agg(F.collect_list("u").alias("pivots")))
    held = materialize(placed(units, pivots).drop("u"))
    rings = held.groupBy("cell", "ring").agg(F.count("*").alias("n")).agg(F.collect_list(F.struct("cell", "ring", "n")).alias("rings"))  # PIVOTS * RINGS at most, in one row
    asked = queries.where(usable(F.col("q"))).select("query_id", "q").withColumn("u", unit(F.col("q")))
    width, away = F.lit(2.0 / RINGS), F.transform("pivots", lambda p: apart(p, F.col("u")))
    asked = asked.crossJoin(F.broadcast(pivots)).withColumn("away", away).crossJoin(F.broadcast(rings)).select("query_id", "q", "away", F.inline("rings"))
    d, inner = F.element_at("away", F.col("cell") + 1), F.col("ring") * width
    asked = asked.withColumns({"least": F.greatest(F.lit(0.0), d - inner - width, inner - d), "most": d + inner + width}).drop("away")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("query_id").orderBy("most", "cell", "ring").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    asked = materialize(asked.withColumn("first", before < k))

    def scored(some: DataFrame) -> DataFrame:
        return some.join(held, ["cell", "ring"]).withColumn("similarity", cosine(F.col("q"), F.col("v")))

    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "vec_id")
    top = lambda f: f.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k)
    one = materialize(top(scored(asked.where("first")).select("query_id", "vec_id", "similarity")))
    # cosines of the k-th result as distances; queries of fewer results have seen all vectors
    bound = one.groupBy("query_id").agg(F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.min("similarity"))).alias("bound"))
    rest = asked.where("not first").join(bound, "query_id").where(F.col("least") <= F.col("bound") + SLACK)
    two = scored(rest).select("query_id", "vec_id", "similarity")
    return top(one.drop("nth").unionByName(two))


def windows(hits: DataFrame) -> DataFrame:
    """Per dataset (missing: ``unknown``), hits and the time from half a day before the first to half a day after the last; zero times are skipped."""
    t = F.when(F.col("timestamp_ms") > 0, F.col("timestamp_ms"))
    return hits.groupBy(F.coalesce("dataset_name", F.lit("unknown")).alias("dataset_name")).agg(
        F.count("*").alias("hits"), (F.min(t) - HALF_DAY_MS).alias("start_ms"), (F.max(t) + HALF_DAY_MS).alias("end_ms")
    )


def summary(hits: DataFrame) -> DataFrame:
    s = F.col("similarity")
    return hits.agg(F.count("*").alias("hits"), F.min(s).alias("least"), F.max(s).alias("most"), F.round(F.avg(s), 6).alias("mean"), F.median(s).alias("median"))


def histogram(hits: DataFrame, bins: int = 10) -> DataFrame:
    return hits.groupBy(F.least(F.floor(F.col("similarity") * bins), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("hits"))
