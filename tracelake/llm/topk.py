"""Exact top-k inner products from a bit-sliced index (operator 7).

Rows are dealt to segments. A segment keeps, for each attribute, the most significant bits of its
values above the segment's least one, one bitmap over the rows for each bit. A query's weights add
these slices with bitmap arithmetic alone (carry-save adders; an attribute under a negative weight
enters complemented). The rows of the k largest sums are picked from the most significant slice of
the sum downward; the bits left out bound the error, so every row whose sum could still reach the
k-th is scored exactly. Rows travel once, to their segment; queries travel to every segment and are
streamed through its index, which is built once. Each segment returns k rows a query.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import floor

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracelake.llm.common import materialize, split_rows
from tracelake.llm.embeddings import clean_vectors

SEGMENT = 65_536  # rows of a segment at most, about
LEAST_SEGMENT = 8192
SEGMENTS = 8  # that fewer rows are dealt to
SLICES = 6
LONG = 2**63


def add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and carry of three bitmaps."""
    t = a ^ b
    return t ^ c, (a & b) | (t & c)


def total(columns: dict[int, list[np.ndarray]]) -> list[np.ndarray | None]:
    """Slices of a sum, least significant first, from bitmaps listed by weight."""
    out, w = [], 0
    while any(k >= w and v for k, v in columns.items()):
        maps = columns.pop(w, [])
        while len(maps) > 2:
            s, c = add(maps.pop(), maps.pop(), maps.pop())
            maps.insert(0, s)
            columns.setdefault(w + 1, []).append(c)
        if len(maps) == 2:
            a, b = maps
            columns.setdefault(w + 1, []).append(a & b)
            maps = [a ^ b]
        out.append(maps[0] if maps else None)
        w += 1
    return out


def count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


class Segment:
    """Bit slices of a segment's rows ``x`` (whole numbers, rows by attributes)."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.low = x.min(axis=0)
        above = x - self.low
        bits = int(above.max(initial=0) if x.dtype != object else max(above.ravel(), default=0)).bit_length()
        self.cut = max(0, bits - SLICES)
        self.slices = min(bits, SLICES)
        above = (above >> self.cut).astype(np.int64).astype(np.uint64)
        pad = -len(x) % 64
        self.valid = self.packed(np.ones(len(x), bool), pad)
        # slices[b] holds, for each attribute, the bitmap of bit b
        self.maps = [np.stack([self.packed((above[:, d] >> np.uint64(b)) & np.uint64(1) > 0, pad) for d in range(x.shape[1])]) for b in range(self.slices)]

    @staticmethod
    def packed(flags: np.ndarray, pad: int) -> np.ndarray:
        return np.packbits(np.pad(flags, (0, pad)), bitorder="little").view(np.uint64)

    def top(self, q: np.ndarray, k: int) -> np.ndarray:
        """Rows that may be among the ``k`` of largest inner product with ``q``; all that are, are among them."""
        if len(self.x) <= k or not self.slices:
            return np.arange(len(self.x))
        weight, columns = np.abs(q), {}
        for t in range(int(max(weight)).bit_length()):
            chosen = np.flatnonzero((weight >> t) & 1)
            # count the chosen attributes' bitmaps, all slices at once
            planes: list[list[np.ndarray]] = [[self.signed[d] if q[d] > 0 else self.complement[d] for d in chosen]]
            level = 0
            while level < len(planes):
                maps = planes[level]
                while len(maps) > 1:
                    s, c = add(maps.pop(), maps.pop(), maps.pop() if maps else self.zero)
                    maps.append(s)
                    if level + 1 == len(planes):
                        planes.append([])
                    planes[level + 1].append(c)
                if maps:
                    for b in range(self.slices):
                        columns.setdefault(t + level + b, []).append(maps[0][b])
                level += 1
        sums = total(columns)
        # from the most significant slice downward: surely among the k, and still in question
        sure, open_ = np.zeros_like(self.valid), self.valid
        threshold = 0
        for w in range(len(sums) - 1, -1, -1):
            s = sums[w] if sums[w] is not None else np.zeros_like(self.valid)
            ones = open_ & s
            n = count(sure | ones)
            if n >= k:
                open_ = ones
                threshold |= 1 << w
            else:
                sure, open_ = sure | ones, open_ & ~s
        # the k-th largest sum is threshold; complemented bits and cut bits add less than this to a score
        slack = int((((1 << self.cut) - 1) * weight.astype(object)).sum()) if self.cut else 0
        least = threshold - (slack >> self.cut)
        if least <= 0:
            return np.arange(len(self.x))
        over, same = np.zeros_like(self.valid), self.valid
        for w in range(max(len(sums), least.bit_length()) - 1, -1, -1):
            s = sums[w] if w < len(sums) and sums[w] is not None else np.zeros_like(self.valid)
            if least >> w & 1:
                same = same & s
            else:
                over, same = over | (same & s), same & ~s
        return np.flatnonzero(np.unpackbits((over | same).view(np.uint8), bitorder="little", count=len(self.x)))

    @property
    def zero(self) -> np.ndarray:
        return np.zeros_like(self.signed[0])

    def prepare(self) -> Segment:
        stacked = np.stack(self.maps, axis=1) if self.maps else np.zeros((self.x.shape[1], 0, len(self.valid)), np.uint64)
        self.signed, self.complement = stacked, ~stacked & self.valid
        return self


def exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whole-number inner products; Python's integers where 64 bits might not do."""
    if x.dtype != object and q.dtype != object and float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * x.shape[1] < 2**62:
        return x @ q
    return x.astype(object) @ q.astype(object)


def quantised(values: list, dim: int, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of each component, missing ones 0; Python's integers where 62 bits don't do."""
    x = np.zeros((len(values), dim))
    for i, v in enumerate(values):
        x[i, : len(v)] = v
    with np.errstate(over="ignore"):
        y = np.floor(x * scale)
    if np.abs(y).max(initial=0) < 2**62:
        return y.astype(np.int64)
    return np.array([[floor(Fraction(c) * scale) for c in row] for row in x.tolist()], dtype=object)


def top_k(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10, every: int = 100, scale: int = 1024) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose id is divisible by ``every``, the ``k`` other rows of largest score.

    A component ``x`` counts as ``floor(scale * x)``, whatever its size; ties go to the smaller id. A score
    that a long can't hold is given as the nearest long, and ranked by its nearest double. Null vectors and those
    with a null or non-finite component take no part; missing trailing components count 0; repeated
    ids count once, with their smallest vector; null ids are left out. No rows give no rows.
    """
    rows = materialize(clean_vectors(df, id_col, vec_col).where("v is not null").withColumn("v", F.col("v").cast("array<double>")))
    n, dim = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    dim = max(int(dim or 0), 1)
    segments = split_rows(n, min(SEGMENT, max(LEAST_SEGMENT, n // SEGMENTS)))
    own = F.pmod(F.xxhash64("id"), F.lit(segments)).cast("int")
    index = rows.select(own.alias("segment"), F.lit(False).alias("query"), "id", "v")
    queries = rows.where(F.col("id") % every == 0).select(F.explode(F.sequence(F.lit(0), F.lit(segments - 1))).alias("segment"), F.lit(True).alias("query"), "id", "v")
    dealt = index.unionByName(queries).repartition(segments, "segment").sortWithinPartitions("segment", "query", "id")

    def best(segment: Segment, ids: np.ndarray, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        for query, weights in zip(queries["id"].tolist(), quantised(queries["v"].tolist(), dim, scale), strict=True):
            at = segment.top(weights, k + 1)  # one more: it may find itself
            at = at[ids[at] != query]
            score = exact(segment.x[at], weights)
            order = sorted(range(len(at)), key=lambda i: (-score[i], ids[at[i]]))[:k] if score.dtype == object else np.lexsort((ids[at], ~score))[:k]
            score = score[order]
            cut = [max(-LONG, min(LONG - 1, x)) for x in score.tolist()]
            out.append(pd.DataFrame({"query_id": query, "vec_id": ids[at][order], "score": np.array(cut, np.int64), "size": [nearest(x) for x in score.tolist()]}))
        return pd.concat(out)

    def stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A segment's rows come first, in the order of ids, then its queries."""
        number, ids, values, segment = None, [], [], None
        for f in frames:
            for (at, query), part in f.groupby(["segment", "query"]):
                if at != number:
                    number, ids, values, segment = at, [], [], None
                if not query:
                    ids.append(part["id"].to_numpy())
                    values.append(quantised(part["v"].tolist(), dim, scale))
                elif ids:
                    if segment is None:
                        segment, names, values = Segment(np.concatenate(values)).prepare(), np.concatenate(ids), []
                    yield best(segment, names, part)

    found = dealt.mapInPandas(stream, "query_id long, vec_id long, score long, size double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("size"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(score: int) -> float:
    """The double nearest to a score that a long can't hold; 0 for the others."""
    if -LONG <= score < LONG:
        return 0.0
    try:
        return float(score)
    except OverflowError:
        return float("inf") if score > 0 else float("-inf")
