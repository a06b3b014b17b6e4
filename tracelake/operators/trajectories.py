"""Trajectories: building, events, segmentation, features."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions.geo import haversine


def build(points: DataFrame, *keys: str) -> DataFrame:
    """One line for each group of two points or more, with its statistics."""
    line = F.transform(F.array_sort(F.collect_list(F.struct("ts", "lon", "lat"))), lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat")))
    v = F.col("twist_linear")
    out = points.groupBy(*(keys or ("dataset_name",))).agg(
        F.min("ts").alias("start_time"), F.max("ts").alias("end_time"), (F.max("ts") - F.min("ts")).alias("duration"), F.count("*").alias("point_count"),
        F.bround(F.avg(v), 2).alias("avg_speed"), F.bround(F.max(v), 2).alias("max_speed"), F.bround(F.min(v), 2).alias("min_speed"),
        F.bround(F.coalesce(F.stddev_samp(v), F.lit(0.0)), 2).alias("std_speed"), F.bround(F.avg(F.when(F.col("avp_flag").isNotNull(), (F.col("avp_flag") == 1).cast("double"))), 3).alias("avp_ratio"), line.alias("line"),
    )
    return out.where("point_count >= 2")


def motion_statistics(points: DataFrame, *keys: str) -> DataFrame:
    """By ``keys``, points, datasets, least, largest and mean speed and acceleration, the mean of absolute accelerations, and the longest path of a dataset in metres. Accelerations are changes to the point before; where no time has passed there is none."""
    w = Window.partitionBy("dataset_name").orderBy("ts", "seq")
    v, accel = F.col("twist_linear"), (F.col("twist_linear") - F.lag("twist_linear").over(w)) / F.nullif(F.col("ts") - F.lag("ts").over(w), F.lit(0))
    moved = steps(points).withColumn("accel", accel)
    spread = lambda c, n: [f(c).alias(f"{p}_{n}") for p, f in (("min", F.min), ("max", F.max), ("avg", F.avg))]
    found = moved.groupBy(*keys).agg(F.count("*").alias("points"), F.countDistinct("dataset_name").alias("datasets"), *spread(v, "speed"), *spread(F.col("accel"), "accel"), F.avg(F.abs("accel")).alias("mean_abs_accel"))
    paths = moved.groupBy(*keys, "dataset_name").agg(F.coalesce(F.sum("step"), F.lit(0.0)).alias("path")).groupBy(*keys).agg(F.max("path").alias("longest_path"))
    return found.join(paths, list(keys))


def avp_changes(points: DataFrame) -> DataFrame:
    """Points where the flag (null is 0) differs from the point before."""
    w = Window.partitionBy("dataset_name").orderBy("ts", "seq")
    flag = F.coalesce("avp_flag", F.lit(0))
    return points.withColumns({"to_avp": flag, "from_avp": F.lag(flag).over(w)}).where("from_avp is not null and from_avp <> to_avp")


def speed_spikes(points: DataFrame, k: float = 2.0) -> DataFrame:
    """Points whose speed lies more than ``k`` standard deviations off the mean; three speeds at least, not all equal."""
    w = Window.partitionBy("dataset_name")
    v = F.col("twist_linear")
    out = points.withColumns({"n": F.count(v).over(w), "mean": F.avg(v).over(w), "std": F.stddev_samp(v).over(w)})
    return out.where("n >= 3 and std > 0").withColumn("z_score", F.abs(v - F.col("mean")) / F.col("std")).where(F.col("z_score") > k)


def events(points: DataFrame) -> DataFrame:
    """Flag changes and speed spikes in one table; what a kind lacks is null."""
    a = avp_changes(points).select("dataset_name", "ts", "seq", F.lit("avp_change").alias("event_type"), "from_avp", "to_avp")
    b = speed_spikes(points).select("dataset_name", "ts", "seq", F.lit("speed_spike").alias("event_type"), F.col("twist_linear").alias("speed"), "z_score")
    return a.unionByName(b, allowMissingColumns=True)


def seconds(points: DataFrame, col: str = "ts", by: str = "dataset_name") -> DataFrame:
    """``points`` with ``seconds``: the unit of a trajectory's times is told from their median."""
    m = F.median(col).over(Window.partitionBy(by))
    scale = F.when(m < 1e10, 1.0).when(m < 1e13, 1e3).when(m < 1e16, 1e6).otherwise(1e9)
    return points.withColumn("seconds", F.col(col) / scale)


def steps(points: DataFrame, *keys: str) -> DataFrame:
    """Points with the distance and time to the point before (null for a group's first)."""
    w = Window.partitionBy(*(keys or ("dataset_name",))).orderBy("ts", "seq")
    before = lambda c: F.lag(c).over(w)
    return points.withColumns({"step": haversine(before("lon"), before("lat"), F.col("lon"), F.col("lat")), "gap": F.col("ts") - before("ts")})


SEGMENT_GAP, SEGMENT_METRES, SEGMENT_SECONDS, SEGMENT_POINTS = 3.0, 50.0, 15.0, 5


def segmented(points: DataFrame) -> DataFrame:
    """Points with ``segment_index``: a trajectory is cut before a point that follows a gap of over 3 s, or reaches 50 m or 15 s.

    Segments of fewer than five points go, and don't use up an index. The cuts depend on running
    sums that start anew, so each trajectory's points are sorted in an array and folded once; what follows by
    trajectory or segment needs no further shuffle.
    """
    own = [c for c in points.columns if c != "dataset_name"]
    order = [c for c in ("ts", "seq") if c in own]
    lines = points.groupBy("dataset_name").agg(F.array_sort(F.collect_list(F.struct(*order, *[c for c in own if c not in order]))).alias("p")).where(F.size("p") >= SEGMENT_POINTS)
    p = lambda i: F.element_at("p", i + 1)

    def walk(s: Column, i: Column) -> Column:
        total = s["total"] + haversine(p(i - 1)["lon"], p(i - 1)["lat"], p(i)["lon"], p(i)["lat"])
        cut = (p(i)["ts"] - p(i - 1)["ts"] > SEGMENT_GAP) | (total >= SEGMENT_METRES) | (p(i)["ts"] - p(s["first"])["ts"] >= SEGMENT_SECONDS)
        closed = F.when(i - s["first"] >= SEGMENT_POINTS, F.concat(s["cuts"], F.array(F.struct(s["first"].alias("at"), (i - s["first"]).alias("n"))))).otherwise(s["cuts"])
        state = lambda first, total, cuts: F.struct(first.alias("first"), total.alias("total"), cuts.alias("cuts"))
        return F.when(cut, state(i, F.lit(0.0), closed)).otherwise(state(s["first"], total, s["cuts"]))

    start = F.struct(F.lit(0).alias("first"), F.lit(0.0).alias("total"), F.array().cast("array<struct<at:int,n:int>>").alias("cuts"))
    last = lambda s: F.when(F.size("p") - s["first"] >= SEGMENT_POINTS, F.concat(s["cuts"], F.array(F.struct(s["first"].alias("at"), (F.size("p") - s["first"]).alias("n"))))).otherwise(s["cuts"])
    cuts = F.aggregate(F.sequence(F.lit(1), F.size("p") - 1), start, walk, last)
    pieces = lines.select("dataset_name", "p", F.posexplode(cuts).alias("segment_index", "c"))
    rows = pieces.select("dataset_name", "segment_index", F.explode(F.slice("p", F.col("c.at") + 1, F.col("c.n"))).alias("q"))
    return rows.select(*[F.col("dataset_name") if c == "dataset_name" else F.col("q").getField(c).alias(c) for c in points.columns], "segment_index")


def segments(points: DataFrame, *more: Column) -> DataFrame:
    """One row for each segment of ``points(dataset_name, segment_index, ...)``: times, length, quality, ten features and ``more`` aggregates."""
    key = ("dataset_name", "segment_index")
    w = Window.partitionBy(*key).orderBy("ts", "seq")
    before = lambda c: F.lag(c).over(w)
    dt = F.greatest(F.col("ts") - before("ts"), F.lit(0.1))
    p = steps(points, *key).withColumns({"accel": (F.col("twist_linear") - before("twist_linear")) / dt, "turn": F.abs(F.col("yaw") - before("yaw")) / dt})
    end = lambda f, c: f(c, F.struct("ts", "seq"))
    v = F.col("twist_linear")
    out = p.groupBy(*key).agg(
        F.min("ts").cast("long").alias("start_time"), F.max("ts").cast("long").alias("end_time"), F.count("*").alias("point_count"),
        F.coalesce(F.sum("step"), F.lit(0.0)).alias("length"), F.coalesce(F.max("step"), F.lit(0.0)).alias("max_step"),
        F.avg(v).alias("avg_speed"), F.stddev_pop(v).alias("std_speed"), F.max(v).alias("max_speed"), F.min(v).alias("min_speed"),
        F.avg("accel").alias("avg_accel"), F.stddev_pop("accel").alias("std_accel"), F.avg("turn").alias("avg_yaw_rate"), F.stddev_pop("yaw").alias("std_yaw"),
        end(F.min_by, "lon").alias("lon1"), end(F.min_by, "lat").alias("lat1"), end(F.max_by, "lon").alias("lon2"), end(F.max_by, "lat").alias("lat2"), *more,
    )
    angle = F.atan2(F.col("lat2") - F.col("lat1"), F.col("lon2") - F.col("lon1"))
    straight = haversine(F.col("lon1"), F.col("lat1"), F.col("lon2"), F.col("lat2"))
    return out.withColumns(
        {
            "duration": F.col("end_time") - F.col("start_time"), "direction_cos": F.cos(angle), "direction_sin": F.sin(angle),
            "curvature": F.col("length") / F.greatest(straight, F.lit(0.001)), "tortuosity": F.when(straight < 1, 1.0).otherwise(F.col("length") / straight), "quality_flag": quality_flag(),
        }
    )


def quality_flag() -> Column:
    return (
        F.when(F.col("point_count") < SEGMENT_POINTS, "insufficient_points")
        .when(F.col("max_step") > 100, "gps_jump")
        .when(F.col("avg_speed") > 30, "excessive_speed")
        .when(F.col("length") < 10, "stationary")
        .otherwise("moving")
    )


def valid(segs: DataFrame) -> DataFrame:
    return segs.where(F.col("quality_flag").isin("moving", "stationary"))


FEATURES = ("avg_speed", "std_speed", "max_speed", "min_speed", "avg_accel", "std_accel", "avg_yaw_rate", "std_yaw", "direction_cos", "direction_sin")


def scaled(rows: DataFrame, *by: str, columns: tuple[str, ...] = FEATURES) -> DataFrame:
    """Columns less their mean over their population deviation in each group; a constant column is only shifted."""
    s = rows.groupBy(*by).agg(*[f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    joined = rows.join(s, list(by)) if by else rows.crossJoin(F.broadcast(s))  # one row
    z = {c: (F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") < 1e-12, 1.0).otherwise(F.col(f"_s_{c}")) for c in columns}
    return joined.withColumns(z).select(*rows.columns)


def direction_entropy(points: DataFrame, *keys: str) -> DataFrame:
    """Entropy (bits) of step directions over eight bins, by group."""
    w = Window.partitionBy(*keys).orderBy("ts", "seq")
    angle = F.atan2(F.col("lat") - F.lag("lat").over(w), F.col("lon") - F.lag("lon").over(w))
    bins = points.withColumn("angle", angle).where("angle is not null").withColumn("bin", F.least(F.floor((F.col("angle") + pi) / (pi / 4)), F.lit(7)))
    return entropy(bins, *keys, name="direction_entropy")


def value_entropy(points: DataFrame, column: str, *keys: str) -> DataFrame:
    """Entropy (bits) of a column over ten equal bins between its least and largest, by group; 0 for a constant."""
    w = Window.partitionBy(*keys)
    lo, hi = F.min(column).over(w), F.max(column).over(w)
    bins = points.withColumns({"lo": lo, "hi": hi}).where(F.col(column).isNotNull())
    bins = bins.withColumn("bin", F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col(column) - F.col("lo")) / ((F.col("hi") - F.col("lo")) / 10)), F.lit(9))).otherwise(F.lit(0)))
    return entropy(bins, *keys, name="value_entropy")


def entropy(binned: DataFrame, *keys: str, name: str) -> DataFrame:
    n = binned.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    p = F.col("n") / F.sum("n").over(Window.partitionBy(*keys))
    return n.withColumn("p", p).groupBy(*keys).agg(F.abs(F.sum(-F.col("p") * F.log2("p"))).alias(name))


def peaks(points: DataFrame, column: str, least: float, *keys: str) -> DataFrame:
    """Strict local extremes of a column beyond ``least`` either way, by group."""
    w = Window.partitionBy(*keys).orderBy("ts", "seq")
    x, a, b = F.col(column), F.lag(column).over(w), F.lead(column).over(w)
    high, low = (x > a) & (x > b), (x < a) & (x < b)
    return points.withColumn("peak", (F.abs(x) > least) & (high | low)).groupBy(*keys).agg(F.count_if("peak").alias("peaks"))
