"""Mixing sources to target weights by Efraimidis-Spirakis sampling (operator 5); DataFrame functions only.

Each source has a target in words. As many complete epochs as fit come first; the rest is a weighted
sample without replacement: a document's key is an exponential variate divided by its quality weight,
documents are taken in the order of keys within their source, and a running sum of sizes stops at the
budget. The last document gives the words that are left.

The running sum never sorts a source in one place: keys fall in slices, a slice's total is an
aggregate, slices are summed up over the (small) table of slices, and rows are sorted within a slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.llm.common import WORD, materialize, split_rows

WEIGHTS = (5, 2, 1)  # sources by name, repeating
MOST = 3  # times its size that a source or document may be taken
SLICE_ROWS = 4096
RANGE_ROWS = 20_000  # sources that are numbered in one task


def uniform(id_col: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on id and seed alone (48 bits of MD5, so that other engines agree)."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), id_col.cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(2**48)


def quality_weight(text: Column) -> Column:
    """Share of letters, digits and white space in the text, from 0.25 to 1: symbols weigh against a document."""
    t = F.coalesce(text, F.lit(""))
    plain = F.length(F.regexp_replace(t, r"[!-/:-@\[-`{-~]+", ""))
    return F.greatest(F.lit(0.25), plain / F.greatest(F.length(t), F.lit(1)))


def numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``nth``, their place by name from 0, null last: ranges are numbered each on its own, after the sizes of those before."""
    order = F.col("source").asc_nulls_last()
    parts = materialize(sources.repartitionByRange(split_rows(sources.count(), RANGE_ROWS), order).withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row for each range
    earlier = parts.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    nth = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1 + F.col("earlier")
    return parts.join(earlier, "part").withColumn("nth", nth).drop("part", "earlier")


def targets(sources: DataFrame) -> DataFrame:
    """``sources(source, source_size)`` with ``target``: shares by weight, cut at three times the size, the excess reshared.

    A round is one aggregation over the sources: the level that is left for those below their cut. It only
    rises, so that what is cut stays cut; the rounds end when no further source reaches its cut.
    """
    cut = F.col("source_size") * MOST
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("nth") % len(WEIGHTS) + 1).cast("int"))
    s = materialize(numbered(sources).withColumn("weight", weight).withColumn("room", cut / F.col("weight")))
    everything, level, full = s.agg(F.sum("source_size")).first()[0] or 0, -1.0, -1
    while True:
        reached = F.col("room") <= F.lit(level)
        r = s.agg(F.sum(F.when(reached, cut).otherwise(0)).alias("used"), F.sum(F.when(reached, 0).otherwise(F.col("weight"))).alias("rest"), F.count_if(reached).alias("full")).first()
        if r["full"] == full or not r["rest"]:
            break
        full, level = r["full"], (everything - r["used"]) / r["rest"]
    return s.withColumn("target", F.when(reached, cut.cast("double")).otherwise(F.col("weight") * F.lit(level))).select("source", "source_size", "target")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, slim: bool = False) -> DataFrame:
    """``docs`` (with ``slim``, its id and source alone) with ``size, source_size, target, taken`` (and ``mix_key``); same-named columns are replaced.

    Null texts have size 0. A null source is a source of its own, last in order. Rows are mixed one
    by one: repeated rows count as often as they stand there (rows equal in id and key are taken in the
    order of their texts, then as Spark meets them, which changes no total). Rows without id are drawn by
    their texts. Sources without words get and
    give nothing. ``taken`` = complete epochs times size, plus the words of the fractional epoch; a
    source's ``taken`` adds up to its target rounded down. No rows give no rows.
    """
    added = ("size", "source_size", "target", "taken", "mix_key")
    if slim:
        rows = sized(docs, id_col, text_col, source_col, seed).select("id", "source", "size", "mix_key", "print")
        return allocate(materialize(rows)).drop("print").withColumnsRenamed({"id": id_col, "source": source_col})
    names = [c for c in docs.columns if c not in added]
    return decided(docs, id_col, text_col, source_col, seed).select(*[F.col("row").getField(c).alias(c) for c in names], *added)


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """``(row, id, source, size, mix_key, print)``: ``row`` holds all columns of ``docs``, ``print`` their hash."""
    text, name = F.col(text_col).cast("string"), F.col(id_col).cast("string")
    key = -F.log(uniform(F.coalesce(name, F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit("")).cast("binary")))), seed)) / quality_weight(text)
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), key.alias("mix_key"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("print"))


def decided(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17) -> DataFrame:
    """``(row, size, source_size, target, taken, mix_key)``: decided without the texts, and joined to them by the rows' hashes."""
    whole = sized(docs, id_col, text_col, source_col, seed)
    slim_rows = materialize(whole.drop("row"))
    whole, keys = whole.select("row", "id", "print"), ["print"]
    if slim_rows.groupBy("print").count().where("count > 1").isEmpty():
        done = allocate(slim_rows)
    else:  # rows of equal hashes are told apart by their number
        nth, keys = F.row_number().over(Window.partitionBy("print").orderBy("id")), ["print", "nth"]
        done, whole = allocate(slim_rows.withColumn("nth", nth)), whole.withColumn("nth", nth)
    done = done.select(*keys, "size", "source_size", "target", "taken", "mix_key")
    return whole.join(done, keys).select("row", "size", "source_size", "target", "taken", "mix_key")


def allocate(slim: DataFrame) -> DataFrame:
    """``slim(id, source, size, mix_key, print)`` with ``source_size, target, taken``."""
    name = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))  # a key that is never null
    slim = slim.withColumn("name", name)
    known = slim.groupBy("name").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count("*").alias("rows"), F.avg("mix_key").alias("mean_key"))
    known = materialize(known.join(targets(known.select("source", "source_size")).select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("name"), "target"), "name").drop("source"))
    slices = F.ceil(F.col("rows") / SLICE_ROWS)
    # keys are nearly exponential: this spreads them evenly over the source's slices, in order
    at = F.floor((1 - F.exp(-F.col("mix_key") / F.greatest("mean_key", F.lit(1e-300)))) * slices)
    rows = slim.join(known, "name").withColumn("slice", F.least(at, slices - 1).cast("long"))
    epochs = F.least(F.lit(MOST), F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))).cast("long")
    rows = materialize(rows.select(*[c for c in slim.columns if c not in ("name", "size", "mix_key")], "name", "slice", "size", "mix_key", "source_size", "target", epochs.alias("epochs")))
    before = Window.partitionBy("name").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("name", "slice").agg(F.sum("size").alias("in_slice")).withColumn("earlier", F.coalesce(F.sum("in_slice").over(before), F.lit(0))).drop("in_slice")
    within = Window.partitionBy("name", "slice").orderBy("mix_key", "id", "print").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = F.sum("size").over(within)
    budget = F.floor(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size")
    rows = rows.join(sums, ["name", "slice"]).withColumn("upto", F.col("earlier") + run)
    part = F.greatest(F.lit(0), F.least(F.col("size"), budget - F.col("upto") + F.col("size")))
    return rows.select(*[c for c in slim.columns if c not in ("name", "size", "mix_key")], "size", "mix_key", "source_size", "target", (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """The mixed corpus: each row of ``docs``, columns unchanged, as often as it is taken (a fractional one if half its words or more are).

    Rows without words aren't taken. Otherwise nulls, ties, repeated rows and empty tables fare as in ``mix``.
    """
    copies = F.when(F.col("size") > 0, F.round(F.col("taken") / F.greatest("size", F.lit(1)))).otherwise(0).cast("int")
    out = decided(docs, id_col, **kw).select("row", copies.alias("copies")).where("copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def once(docs: DataFrame, id_col: str) -> DataFrame:
    """Of rows that repeat an id, one (that of the smallest hash of all columns); rows without id all stay, and all columns do."""
    ids = docs.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count("*").alias("n")).where("n > 1").select(id_col)
    if ids.isEmpty():
        return docs
    names = [F.col(f"`{c}`") for c in docs.columns]
    nth = F.row_number().over(Window.partitionBy(id_col).orderBy(F.xxhash64(*names)))
    out = docs.select(F.struct(*names).alias("row"), F.when(F.col(id_col).isNull(), 1).otherwise(nth).alias("nth")).where("nth = 1")
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
