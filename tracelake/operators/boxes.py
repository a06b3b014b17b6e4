"""Boxes of trajectories, and joins of boxes by where they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.functions.geo import contains, overlaps, within_distance
from tracelake.functions.graph import materialize


BOX = ["xmin", "ymin", "xmax", "ymax"]
TILE = 512  # rows of a cell that meet as many of the other side in one task
MEMBERS = 64  # rows of one envelope that travel as one
HELD = 8192  # as TILE, where rows hold members: so many of these


def extents(points: DataFrame, *keys: str) -> DataFrame:
    """Envelope and goodness (all known work stages are 2) of each group of points."""
    return points.groupBy(*keys).agg(
        F.min("lon").alias("xmin"), F.max("lon").alias("xmax"), F.min("lat").alias("ymin"), F.max("lat").alias("ymax"), F.bool_and(F.col("workstage") == 2).alias("all_good")
    )


def shaped(boxes: DataFrame) -> DataFrame:
    """Boxes with no width or no height become their midpoint."""
    point = (F.col("xmin") == F.col("xmax")) | (F.col("ymin") == F.col("ymax"))
    mid = lambda a, b: (F.col(a) + F.col(b)) / 2
    x, y = mid("xmin", "xmax"), mid("ymin", "ymax")
    pick = lambda c, m: F.when(point, m).otherwise(F.col(c)).alias(c)
    rest = [c for c in boxes.columns if c not in ("xmin", "xmax", "ymin", "ymax")]
    return boxes.select(*rest, pick("xmin", x), pick("xmax", x), pick("ymin", y), pick("ymax", y), F.when(point, "POINT").otherwise("POLYGON").alias("shape"))


def cells(frame: DataFrame, size: float, p: str = "", grow: float = 0.0) -> DataFrame:
    """A row for each grid cell ``(gx, gy)`` that a box covers, borders included."""
    at = lambda c, d: F.floor((F.col(f"{p}{c}") + d) / F.lit(size)).cast("long")
    return frame.withColumn("gx", F.explode(F.sequence(at("xmin", -grow), at("xmax", grow)))).withColumn("gy", F.explode(F.sequence(at("ymin", -grow), at("ymax", grow))))


def cell_join(left: DataFrame, right: DataFrame, keys: list[str], tile: int = TILE) -> DataFrame:
    """Inner join on ``keys`` of rows that are dealt to cells, any number of which may share a cell.

    A cell of more than ``tile`` rows of a side is split into tiles of about that many, each of which meets each tile of the
    other side in a task of its own; a side of ``folded`` rows is split by what they hold, ``HELD`` a tile. Only the list of such cells is broadcast; neither side ever is, since Spark takes
    rows that were dealt to cells for as few as they were before.
    """
    held = lambda f: [(F.sum(F.size(c)), HELD) for c in f.columns if c.endswith("members")]
    load = {n: (held(f) or [(F.count("*"), tile)])[0] for f, n in ((left, "_nl"), (right, "_nr"))}
    sizes = lambda f, n: f.groupBy(*keys).agg(load[n][0].alias(n)).where(F.col(n) > load[n][1])
    parts = lambda n: F.coalesce(F.ceil(F.col(n) / load[n][1]).cast("int"), F.lit(1))
    hot = sizes(left, "_nl").join(sizes(right, "_nr").hint("merge"), keys, "full")
    every = lambda n: F.explode(F.sequence(F.lit(0), parts(n) - 1))
    own = lambda f, n: F.pmod(F.xxhash64(*f.columns), parts(n)).cast("int")
    a, b = (f.join(F.broadcast(hot), keys, "left") for f in (left, right))
    a = a.withColumn("_i", own(left, "_nl")).withColumn("_j", every("_nr")).drop("_nl", "_nr")
    b = b.withColumn("_j", own(right, "_nr")).withColumn("_i", every("_nl")).drop("_nl", "_nr")
    # a fixed number of partitions, since few bytes can make very many pairs
    to = [*keys, "_i", "_j"]
    a, b = (f.repartition(int(f.sparkSession.conf.get("spark.sql.shuffle.partitions")), *to) for f in (a, b))
    return a.join(b.hint("merge"), to).drop("_i", "_j")


def folded(frame: DataFrame, most: int = MEMBERS) -> DataFrame:
    """Rows of equal envelopes as one: the envelope and ``members``, an array of at most about ``most`` rows' other columns. Rows without an envelope are left out."""
    rest = [c for c in frame.columns if c not in BOX]
    frame = frame.dropna(subset=BOX)
    sizes = frame.groupBy(*BOX).agg(F.count("*").alias("_n")).where(F.col("_n") > most)
    part = F.pmod(F.xxhash64(*rest), F.coalesce(F.ceil(F.col("_n") / most).cast("int"), F.lit(1)))
    dealt = frame.join(sizes.hint("merge"), BOX, "left").withColumn("_part", part)
    return dealt.groupBy(*BOX, "_part").agg(F.collect_list(F.struct(*rest)).alias("members")).drop("_part")


def unfolded(met: DataFrame, *prefixes: str) -> DataFrame:
    """The rows that ``folded`` rows with prefixed columns stand for."""
    for p in prefixes:
        met = met.withColumn("_m", F.explode(f"{p}members")).drop(f"{p}members")
        met = met.select(*[c for c in met.columns if c != "_m"], *[F.col("_m").getField(f.name).alias(f"{p}{f.name}") for f in met.schema["_m"].dataType.fields])
    return met


def box_join(left: DataFrame, right: DataFrame, size: float = 0.002, how: str = "intersects", distance: float = 0.0) -> DataFrame:
    """Pairs of boxes that meet ``how`` (intersects, within, contains, dwithin), columns prefixed ``l_`` and ``r_``.

    Both sides are dealt to the cells they cover, so that an equi-join finds the pairs, each in the one
    cell that holds the lower left corner of what they share: no deduplication follows. Cells of very many boxes are
    split (``cell_join``).
    """
    grow = distance if how == "dwithin" else 0.0
    left, right = left.toDF(*[f"l_{c}" for c in left.columns]), right.toDF(*[f"r_{c}" for c in right.columns])
    both = cell_join(cells(left, size, "l_", grow), cells(right, size, "r_"), ["gx", "gy"])
    corner = lambda c: F.floor(F.greatest(F.col(f"l_{c}") - F.lit(grow), F.col(f"r_{c}")) / F.lit(size)).cast("long")
    tests: dict[str, Column] = {"intersects": overlaps("l_", "r_"), "within": contains("r_", "l_"), "contains": contains("l_", "r_"), "dwithin": within_distance("l_", "r_", distance)}
    return both.where((F.col("gx") == corner("xmin")) & (F.col("gy") == corner("ymin")) & tests[how]).drop("gx", "gy")


def met_classes(boxes: DataFrame, objects: DataFrame, *by: str, size: float = 0.002) -> DataFrame:
    """Which distinct envelopes meet: ``l_`` and ``r_`` columns of boxes and objects, ``l_n`` boxes of each envelope (and of each value of ``by``)."""
    left = boxes.groupBy(*BOX, *by).agg(F.count("*").alias("n"))
    return materialize(box_join(left, objects.select(*BOX).distinct(), size))


def side(met: DataFrame, p: str, *more: str) -> DataFrame:
    """Envelopes of one side of ``met_classes``, without the prefix, and ``more`` of its columns."""
    return met.select(*[F.col(f"{p}{c}").alias(c) for c in BOX], *more)


def hit_counts(boxes: DataFrame, objects: DataFrame, key: str, size: float = 0.002) -> DataFrame:
    """Number of objects that each box meets; boxes that meet none keep 0. Equal envelopes are compared once."""
    met = met_classes(boxes, objects, size=size)
    objects = objects.groupBy(*BOX).agg(F.count("*").alias("hits"))
    hits = side(met, "r_", *[F.col(f"l_{c}") for c in BOX]).join(objects, BOX).groupBy(*[F.col(f"l_{c}").alias(c) for c in BOX]).agg(F.sum("hits").alias("hits"))
    found = boxes.select(key, *BOX).join(hits, BOX).groupBy(key).agg(F.sum("hits").alias("hits"))
    return boxes.select(key).join(found, key, "left").select(key, F.coalesce("hits", F.lit(0)).alias("hits"))


def pairs(boxes: DataFrame, crossings: DataFrame, size: float = 0.002) -> DataFrame:
    """The join that analyses are run on: one row for each box and crossing that meet. Equal envelopes are compared once."""
    names, kinds = ["scene_token", "city_id", "subdataset_name"], ["intersection_id", "intersectiontype", "intersectionsubtype"]
    met = box_join(folded(boxes.select(*BOX, *names)), folded(crossings.select(*BOX, *kinds)), size)
    return unfolded(met, "l_", "r_").select(*[F.col(f"l_{c}").alias(c) for c in names], *[F.col(f"r_{c}").alias(c) for c in (*kinds, *BOX)])


#: Labels of the codes (fixed values).
TYPES = {1: "Intersection", 2: "Toll Station", 3: "Lane Change Area", 4: "T-Junction Area", 5: "Roundabout", 6: "H-Junction Area", 7: "Invalid", 8: "Toll Booth Area"}
SUBTYPES = {1: "Regular", 2: "T-Junction with Through Markings", 3: "Minor Junction (No Traffic Conflict)", 4: "Unmarked Junction", 5: "Secondary Junction", 6: "Conservative Through Junction", 7: "Invalid"}


def label(code: Column, names: dict[int, str]) -> Column:
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.coalesce(F.try_element_at(table, code.cast("int")), F.lit("Unknown"))


def analysis(found: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Meetings and distinct crossings by any of the pairs' columns; without columns, totals with distinct scenes."""
    counts = [F.count("*").alias("intersection_count"), F.countDistinct("intersection_id").alias("unique_intersections")]
    if not by:
        return found.agg(*counts, F.countDistinct("scene_token").alias("unique_scenes"))
    return found.groupBy(*by).agg(*counts)


def analysed(boxes: DataFrame, crossings: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``analysis`` of ``pairs``, which are counted by envelopes and never made."""
    own = [c for c in by if c in boxes.columns]
    rest = [c for c in by if c not in own]
    met = met_classes(boxes, crossings, *own)
    sums = ["intersection_count", "unique_intersections", *(() if by else ("unique_scenes",))]
    parts = lambda f, **found: f.select(*by, *[found.get(c, F.lit(0)).cast("long").alias(c) for c in sums])
    kinds = crossings.groupBy(*BOX, *rest).agg(F.count("*").alias("n"))
    names = [F.col(f"l_{c}").alias(c) for c in own]
    counts = parts(side(met, "r_", "l_n", *names).join(kinds, BOX).groupBy(*by).agg(F.sum(F.col("l_n") * F.col("n")).alias("k")), intersection_count=F.col("k"))
    touched = crossings.select(*BOX, *rest, "intersection_id").join(side(met, "r_", *names).distinct(), BOX)
    out = counts.unionByName(parts(touched.groupBy(*by).agg(F.countDistinct("intersection_id").alias("k")), unique_intersections=F.col("k")))
    if not by:
        scenes = boxes.join(side(met, "l_").distinct(), BOX, "left_semi").agg(F.countDistinct("scene_token").alias("k"))
        out = out.unionByName(parts(scenes, unique_scenes=F.col("k")))
    return out.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])


def named_result(grouped: DataFrame, dimension: str, params: dict) -> DataFrame:
    """Result rows with a readable group name and the parameters as JSON."""
    names = {"intersectiontype": TYPES, "intersectionsubtype": SUBTYPES}.get(dimension)
    value = F.col(dimension).cast("string") if dimension in grouped.columns else F.lit("overall")
    shown = label(F.col(dimension), names) if names else value
    return grouped.select(F.lit(dimension).alias("group_dimension"), value.alias("group_value"), shown.alias("group_name"), "intersection_count", F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in params.items()])).alias("analysis_params"))
