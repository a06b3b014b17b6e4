"""Quality by importance resampling (operator 4).

Two generative models over hashed byte n-grams, one of target (labelled good) texts and one of all
texts, give each document the log of its importance weight, the sum of its n-grams' log-ratios.
Gumbel noise drawn from the id's hash turns the k largest perturbed weights into a sample without
replacement. Counts cover all documents; k is the number of documents whose weight reaches the level
that parts good labelled documents from bad.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import materialize, small, slices

HASHED = 1 << 15
BUCKETS = HASHED + 8  # the last for patterns of repeated words
ORDERS = (2, 3, 4)
SMOOTH = 1.0
KEEP = 0.999  # of good labelled documents reach the level, where good and bad overlap


def buckets(text: str | None) -> np.ndarray:
    """Buckets of a text's byte n-grams, and of its words' repetitions; empty for null and for texts shorter than two bytes."""
    b = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    parts, code = [], b
    for n in range(2, max(ORDERS) + 1):
        if len(b) < n:
            break
        code = code[:-1] * np.uint32(257) + b[n - 1 :]
        if n in ORDERS:
            parts.append((code * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(32 - 15))
    words = (text or "").split()
    if len(words) > 3:  # trigrams of "the same word as before"
        same = np.fromiter(map(eq, words, words[1:]), np.uint32, len(words) - 1)
        parts.append(HASHED + same[:-2] * np.uint32(4) + same[1:-1] * np.uint32(2) + same[2:])
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def log_ratios(docs: DataFrame) -> np.ndarray:
    """Log of the bucket probabilities' ratio, target to raw, from all of ``docs(text, target)``."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in slices(batches):
            for text, good in zip(batch.column("text"), batch.column("target").to_pylist(), strict=True):
                n = np.bincount(buckets(text.as_py()), minlength=BUCKETS)
                raw += n
                if good:
                    target += n
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(raw[at]), pa.array(target[at])], ["bucket", "raw", "target"])

    counts = docs.mapInArrow(tally, "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.full(BUCKETS, SMOOTH), np.full(BUCKETS, SMOOTH)
    raw[counts["bucket"]] += counts["raw"]
    target[counts["bucket"]] += counts["target"]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weighted(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """``(id, print, log_weight)``; the weight is null for texts without n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            w = []
            for text in batch.column("text"):
                b = buckets(text.as_py())
                w.append(float(ratios[b].sum()) if len(b) else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("print"), pa.array(w, pa.float64())], ["id", "print", "log_weight"])

    kind = dict(docs.dtypes)["id"]
    return docs.select("id", "print", "text").mapInArrow(run, f"id {kind}, print long, log_weight double")


def kth_largest(df: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value of a column (nulls left out): histograms narrow it down, no sort of all rows."""
    df = df.where(F.col(column).isNotNull()).select(F.col(column).alias("x"))
    n, lo, hi = df.agg(F.count("*"), F.min("x"), F.max("x")).first()
    if not n or k < 1:
        return None
    if k >= n:
        return lo
    above, inside = 0, n
    while inside > 10_000 and hi > lo:
        width = (hi - lo) / 1024
        part = df.where(F.col("x").between(lo, hi)).groupBy(F.least(F.floor((F.col("x") - lo) / width), F.lit(1023)).alias("bin"))
        for b in sorted(part.agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect(), key=lambda r: -r["bin"]):
            if above + b["n"] >= k:
                lo, hi, inside = b["lo"], b["hi"], b["n"]
                break
            above += b["n"]
    if hi == lo:
        return lo
    return df.where(F.col("x").between(lo, hi)).orderBy(F.desc("x")).limit(k - above).agg(F.min("x")).first()[0]


def level(labelled: DataFrame) -> float:
    """Weight that parts good from bad in ``labelled(log_weight, quality)``."""
    q = labelled.where("log_weight is not null").agg(
        F.percentile_approx(F.when(F.col("quality") == 1, F.col("log_weight")), 1 - KEEP, 10_000).alias("good"),
        F.percentile_approx(F.when(F.col("quality") == 0, F.col("log_weight")), 0.99, 10_000).alias("bad"),
    ).first()
    if q["good"] is None:
        return 0.0 if q["bad"] is None else q["bad"]
    return q["good"] if q["bad"] is None or q["bad"] >= q["good"] else (q["good"] + q["bad"]) / 2


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, print, log_weight, gumbel_key, kept)``, one row for each row of ``docs``; ``print`` is the text's hash.

    ``labels`` has the id and ``quality`` (1 good, 0 bad; others and ids labelled both ways are ignored).
    Texts without n-grams (null, empty, one byte) have no weight and are not kept. Repeated rows fare
    alike. Equal keys at the k-th place are all kept. Without labels nothing is known and all with a
    weight are kept.
    """
    known = labels.select(F.col(id_col).alias("id"), "quality").where("id is not null and quality in (0, 1)").groupBy("id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most").drop("most")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("print", F.xxhash64("text"))
    good = known.where("quality = 1").select("id", F.lit(True).alias("target"))
    ratios = log_ratios(rows.join(small(good), "id", "left").select("text", "target"))
    weights = materialize(weighted(rows, ratios))
    cut = level(weights.join(known, "id"))
    k = weights.where(F.col("log_weight") >= cut).count()
    unit = (F.pmod(F.xxhash64("id", F.lit(29)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keyed = materialize(weights.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(unit))))
    last = kth_largest(keyed, "gumbel_key", k)
    return keyed.withColumn("kept", F.coalesce(F.col("gumbel_key") >= F.lit(last), F.lit(False)))
