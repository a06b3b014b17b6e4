"""MinHash near-duplicates by SetSketch registers (operator 3).

A document's set holds its distinct 5-word shingles as 64-bit fingerprints. Register ``j`` of its
sketch keeps ``floor(1 - log_b(min_s x_j(s)))`` where ``x_j(s)`` is exponentially distributed: the
minima are truncated on an exponential scale, merge by maximum, and agree between two sets the more
often the more alike they are. Bands of registers choose candidates, the joint likelihood of the two
sketches (given both set sizes) weeds them out, and full sets decide.

Skew: equal sets are folded first (one aggregation by fingerprint of the set). A bucket of any size
then gets one hub, to which all its members are compared. Of what stays in different components after
that, members outside the bucket's largest component (outsiders) are compared with all members, in
tiles of bounded size, within which links already implied are left out. So no bucket's pairs are ever
written out as rows, and members of its largest component travel once for each block of outsiders.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import connected_components, materialize, slices, small

REGISTERS = 144
BANDS, ROWS = 28, 4  # at similarity 0.75 all bands miss with probability 2e-5, at 0.8 with 4e-7
BASE = 1.02  # of the registers' exponential scale
SHINGLE = 5
SLACK = 0.16  # estimates this far below the threshold (over 4 standard deviations) go unverified
TILE = 2048  # rows of a block
BROADCAST_IDS = 2_000_000  # 16 bytes each
WEIGHTS = np.random.default_rng(11).integers(1, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)
MULTIPLIERS = np.random.default_rng(7).integers(1, 2**63, REGISTERS, dtype=np.uint64) | np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


class Fingerprints(dict):
    """64-bit hash of each word, kept while it holds fewer than 200,000 words."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < 200_000:
            self[word] = h
        return h


def shingle_set(text: str | None, words: Fingerprints) -> np.ndarray:
    """Sorted distinct shingle fingerprints of a whole text; empty for null or wordless texts."""
    if not text:
        return np.zeros(0, np.uint64)
    tokens = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII only, both
    if not tokens:
        return np.zeros(0, np.uint64)
    h = np.fromiter((words[t] for t in tokens), np.uint64, len(tokens))
    k = min(SHINGLE, len(h))
    n = len(h) - k + 1
    acc = np.full(n, k, np.uint64)
    for i in range(k):
        acc = mixed(acc * WEIGHTS[i] + h[i : i + n])
    return np.unique(acc)


def registers(sets: np.ndarray) -> np.ndarray:
    """The SetSketch of a set that isn't empty."""
    low = np.full(len(MULTIPLIERS), np.iinfo(np.uint64).max)
    for i in range(0, len(sets), 2048):
        low = np.minimum(low, np.multiply.outer(MULTIPLIERS, sets[i : i + 2048]).min(axis=1))
    x = -np.log1p(-(low.astype(np.float64) + 1) / 2**64 * (1 - 1e-16))
    return np.clip(np.floor(1 - np.log(np.maximum(x, 1e-300)) / np.log(BASE)), 0, 65535).astype(np.uint16)


def slope(j: float, equal, larger, smaller, n_u, n_v) -> np.ndarray:
    """Derivative at similarity ``j`` of the joint log-likelihood, which is concave: not negative where the likeliest similarity is ``j`` or more.

    ``equal``, ``larger`` and ``smaller`` count the registers that agree or differ either way.
    """
    u = n_u / (n_u + n_v)
    v = 1 - u
    c = (BASE - 1) / BASE
    p = lambda x: np.clip(-np.log1p(-x * c) / np.log(BASE), 1e-9, 1 - 1e-9)
    rate = lambda x: c / ((1 - x * c) * np.log(BASE))
    x, y = np.maximum(u - v * j, 0), np.maximum(v - u * j, 0)
    up, down, dx, dy = p(x), p(y), -v * rate(x), -u * rate(y)
    return larger * dx / up + smaller * dy / down - equal * (dx + dy) / np.maximum(1 - up - down, 1e-9)


def similar(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, least: float, band: int | None = None) -> np.ndarray:
    """Which pairs of sketches (rows of ``a`` and ``b``) may reach ``least``; with ``band``, only those that agree in no earlier band."""
    at = np.flatnonzero(np.minimum(n_a, n_b) >= least * np.maximum(n_a, n_b))
    same = np.broadcast_to(a, b.shape)[at] == b[at]
    equal = same.sum(axis=1)
    ok = equal >= (least - SLACK) * b.shape[1] * 0.9
    at, same, equal = at[ok], same[ok], equal[ok]
    if band is not None and len(at):
        ok = same[:, : BANDS * ROWS].reshape(len(at), BANDS, ROWS).all(axis=2).argmax(axis=1) == band
        at, equal = at[ok], equal[ok]
    if len(at):
        more = (np.broadcast_to(a, b.shape)[at] > b[at]).sum(axis=1)
        pick = lambda n: np.broadcast_to(n, len(b))[at].astype(float)
        at = at[slope(least - SLACK, equal, more, b.shape[1] - equal - more, pick(n_a), pick(n_b)) >= 0]
    maybe = np.zeros(len(b), bool)
    maybe[at] = True
    return maybe


def sketched(docs: DataFrame) -> DataFrame:
    """``(id, n, fold, sketch)``: set size, 128-bit fingerprint of the set, registers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Fingerprints()
        for batch in slices(batches):
            sets = [shingle_set(t.as_py(), words) for t in batch.column("text")]
            n = pa.array([len(s) for s in sets], pa.int64())
            fold = pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary())
            sketch = pa.array([registers(s).tobytes() if len(s) else None for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), n, fold, sketch], ["id", "n", "fold", "sketch"])

    return docs.mapInArrow(run, "id long, n long, fold binary, sketch binary")


def banded(sketches: DataFrame) -> DataFrame:
    """``(key, id, n)`` for every band; the band is the key's last five bits."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            keys = [xxhash.xxh3_64_intdigest(s[i * ROWS * 2 : (i + 1) * ROWS * 2], i) & ~31 | i for s in f["sketch"] for i in range(BANDS)]
            yield pd.DataFrame({"key": np.array(keys, np.uint64).view(np.int64), "id": np.repeat(f["id"].to_numpy(), BANDS), "n": np.repeat(f["n"].to_numpy(), BANDS)})

    return sketches.mapInPandas(run, "key long, id long, n long")


def among(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose id is in ``ids``; the ids are broadcast only where their number is known to be small."""
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")


def with_sets(docs: DataFrame) -> DataFrame:
    """``(id, shingles)``, the sorted set as 8-byte words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Fingerprints()
        for batch in slices(batches):
            sets = [shingle_set(t.as_py(), words).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sets, pa.binary())], ["id", "shingles"])

    return docs.mapInArrow(run, "id long, shingles binary")


def links_to(x: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the other sorted sets are alike enough to the sorted set ``x``; none of them is empty."""
    sizes = np.array([len(y) for y in others])
    flat = np.concatenate(others)
    hit = x[np.minimum(np.searchsorted(x, flat), len(x) - 1)] == flat
    both = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * both >= percent * (len(x) + sizes - both)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are alike enough."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            ok = [links_to(np.frombuffer(x, np.uint64), [np.frombuffer(y, np.uint64)], percent)[0] for x, y in zip(f["sa"], f["sb"], strict=True)]
            yield f.loc[ok, ["a", "b"]]

    whole = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    return whole.mapInPandas(run, "a long, b long")


def tiles(members: DataFrame) -> DataFrame:
    """Tiles ``(key, i, j)`` of ``members(key, id, component)``: block ``i`` of a bucket's outsiders (``asks``) and block ``j`` of all its members.

    Buckets whose members are all in one component have no tiles.
    """
    parts = members.groupBy("key", "component").agg(F.count("*").alias("n"))
    sizes = parts.groupBy("key").agg(F.sum("n").alias("size"), F.max(F.struct("n", "component")).alias("main")).where("size > main.n")
    sizes = small(materialize(sizes), 500_000)  # then members of a large bucket stay where they are
    block = lambda n: F.ceil(n / TILE).cast("int")
    m = members.join(sizes, "key").withColumn("outsider", F.col("component") != F.col("main.component"))
    m = m.withColumns({"askers": block(F.col("size") - F.col("main.n")), "asked": block(F.col("size"))})
    at = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    spot = lambda asks, i, j: F.struct(F.lit(asks).alias("asks"), i.alias("i"), j.alias("j"))
    asked = F.transform(each("askers"), lambda i: spot(False, i, at("asked")))
    asks = F.when(F.col("outsider"), F.transform(each("asked"), lambda j: spot(True, at("askers"), j))).otherwise(F.array().cast("array<struct<asks:boolean,i:int,j:int>>"))
    return m.select("key", "id", "component", "outsider", F.explode(F.concat(asked, asks)).alias("spot")).select("key", "id", "component", "outsider", "spot.*")


class Tile:
    """A block of a bucket's outsiders and one of its members, with their components so far."""

    def __init__(self, f: pd.DataFrame):
        self.frame = f = f.sort_values(["asks", "id"]).reset_index(drop=True)
        self.ids, self.n, self.comps = f["id"].to_numpy(), f["n"].to_numpy(), f["component"].to_numpy().copy()
        self.sketch = np.frombuffer(b"".join(f["sketch"]), np.uint16).reshape(len(f), -1)
        self.outside = f["outsider"].to_numpy()
        self.asked = int((~f["asks"].to_numpy()).sum())
        self.outsiders = range(self.asked, len(f))

    def partners(self, x: int, band: int, least: float) -> np.ndarray:
        """Members that may be linked with outsider ``x``, aren't in its component and meet it here first; of two outsiders the smaller id asks."""
        m = slice(0, self.asked)
        at = np.flatnonzero((self.comps[m] != self.comps[x]) & (~self.outside[m] | (self.ids[m] > self.ids[x])))
        return at[similar(self.sketch[x], self.sketch[at], np.array(self.n[x]), self.n[at], least, band)]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """``(id, n_shingles, component_id, kept)``, one row per document id.

    Null, empty and wordless texts have an empty set, link with nothing and are kept. A text with
    fewer than five words is one shingle. Texts are read whole. A null id is left out; repeated ids
    (whether or not their texts agree) count as one document with the smallest of their texts. Other
    columns are ignored, whatever their names. No rows give no rows.
    """
    least = percent / 100
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    base = materialize(sketched(docs))
    if base.count() != base.agg(F.countDistinct("id")).first()[0]:
        docs = docs.groupBy("id").agg(F.min("text").alias("text"))
        base = materialize(sketched(docs))

    folds = base.where("fold is not null").groupBy("fold").agg(F.min("id").alias("rep"))
    reps = base.join(folds.select(F.col("rep").alias("id")), "id", "left_semi").select("id", "n", "sketch")
    sketches = materialize(reps)
    buckets = materialize(banded(sketches))
    counts = buckets.groupBy("key").agg(F.count("*").alias("size"), F.min("id").alias("hub"), F.min_by("n", "id").alias("hub_n")).where("size > 1")
    buckets = materialize(buckets.join(counts, "key"))

    # 1. every member against its bucket's hub
    @F.pandas_udf("boolean")
    def may(sa: pd.Series, sb: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
        a, b = (np.frombuffer(b"".join(s), np.uint16).reshape(len(s), -1) for s in (sa, sb))
        return pd.Series(similar(a, b, na.to_numpy(), nb.to_numpy(), least)) if len(sa) else pd.Series([], dtype=bool)

    pairs = buckets.where("id <> hub").where(F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * percent).select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    pairs = pairs.join(sketches.toDF("a", "na", "sa"), "a").join(sketches.toDF("b", "nb", "sb"), "b")
    pairs = materialize(pairs.where(may("sa", "sb", "na", "nb")).select("a", "b"))
    wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    links = materialize(verified(pairs, materialize(with_sets(among(docs, wanted))), percent))
    groups = connected_components(links.toDF("src", "dst")).toDF("id", "component")

    # 2. members of a bucket that are still apart: first by sketches, in tiles
    apart = buckets.where("size > 2").select("key", "id").join(groups, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    around = tiles(apart).join(sketches, "id")  # round 1 has compared a hub with a single member

    def meet(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        bucket, i, j = key
        tile, out, band = Tile(f), set(), bucket & 31
        for x in tile.outsiders:
            ok = tile.partners(x, band, least)
            if len(ok):
                out.add(x)
                out.update(ok.tolist())
        out = pd.DataFrame({"id": np.unique(tile.ids[sorted(out)])})
        return out.assign(key=bucket, i=i, j=j)[["key", "i", "j", "id"]]

    near = materialize(around.groupBy("key", "i", "j").applyInPandas(meet, "key long, i int, j int, id long"))
    wanted = near.select("id").distinct()
    sets = materialize(with_sets(among(docs, wanted)))

    # then by full sets, leaving out what is implied
    def decide(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        tile, out = Tile(f), []
        sets = [np.frombuffer(x, np.uint64) for x in tile.frame["shingles"]]
        for x in tile.outsiders:
            at = tile.partners(x, key[0] & 31, least)
            for y in at[links_to(sets[x], [sets[y] for y in at], percent)].tolist() if len(at) else ():
                p, q = tile.comps[x], tile.comps[y]
                if p != q:
                    tile.comps[tile.comps == q] = p
                    out.append((tile.ids[x], tile.ids[y]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    found = around.join(near, ["key", "i", "j", "id"]).join(sets, "id")
    more = found.groupBy("key", "i", "j").applyInPandas(decide, "a long, b long")
    links = materialize(links.unionByName(more).distinct())
    groups = connected_components(links.toDF("src", "dst")).toDF("rep", "component")
    named = folds.join(groups, "rep", "left").select("fold", F.coalesce("component", "rep").alias("component"))
    return (
        base.select("id", "n", "fold")
        .join(named, "fold", "left")
        .select(F.col("id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
        .withColumn("kept", F.col("id") == F.col("component_id"))
    )
