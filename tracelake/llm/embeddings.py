"""Embedding near-duplicates by a subspace pigeonhole join (operator 1).

Cosine >= t between unit vectors means squared distance <= 2 - 2t. Vectors are turned by a fixed
random rotation and cut into blocks of few dimensions; each block gets a share of that budget in
proportion to its dimensions, so a linked pair must keep within the share in one block at least.

Equal vectors are folded first and count as often as they stand there. The rest is dealt to the cell of
the nearest pivot (as many pivots as there are tiles' worth of rows), large cells to several groups.
Two groups meet in one tile unless, in every block, the distance of their pivots less the radii of their
cells exceeds the block's share; in a tile the same holds for chunks of rows. What is left is range-joined
block by block, and the union of the blocks' candidates is verified by cosine in double precision. Each
tile reads its two groups once for all blocks. Only counts for each vector and a spanning forest of the
links leave a tile, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import connected_components, materialize, small

BLOCKS = 4
TILE = 65_536  # rows of a group at most, about; two groups meet in one task
LEAST_GROUPS = 4  # groups that fewer rows are dealt to
PIVOTS = 4096  # at most this many vectors, those of the smallest hashes, reach the driver
SLACK = 1e-7  # rounding of squared distances
SINGLE_SLACK = 1e-5  # and of those in single precision, of coordinates up to 1
DENSE = 0.02  # share of candidates from which a chunk is verified whole
CLOSE = 1e-9  # cosines this near the threshold are summed again, one by one


def clean_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, v)``: one array of floats or doubles for each id, null where it takes no part (null, or a null or non-finite component)."""
    single = dict(df.dtypes)[vec_col] == "array<float>"
    v = F.col(vec_col) if single else F.col(vec_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.when(fine, v).alias("v")).where("id is not null")
    if rows.groupBy("id").count().where("count > 1").isEmpty():
        return rows
    return rows.groupBy("id").agg(F.min("v").alias("v"))


def unit(rows: pd.Series, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors padded with zeros, and which rows have one."""
    x = np.zeros((len(rows), dim))
    for k, v in enumerate(rows):
        if v is not None and len(v):
            x[k, : len(v)] = v
    x /= np.maximum(np.abs(x).max(axis=1, initial=0), 1e-300)[:, None]
    norm = np.sqrt((x * x).sum(axis=1))
    return x / np.maximum(norm, 1e-300)[:, None], norm > 0


def forest(i: np.ndarray, j: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Positions of pairs that join two trees; ``root`` is brought up to date."""
    picked = []
    while True:
        a, b = root[i], root[j]
        at = np.flatnonzero(a != b)
        if not len(at):
            return np.concatenate(picked) if picked else at
        high, first = np.unique(np.maximum(a[at], b[at]), return_index=True)
        parent = np.arange(len(root))
        parent[high] = np.minimum(a[at], b[at])[first]
        picked.append(at[first])
        while (parent[parent] != parent).any():
            parent = parent[parent]
        root[:] = parent[root]


class Chunk:
    """Rows of a tile with, for each block, coordinates in single precision, centre and radius."""

    def __init__(self, y: np.ndarray, bounds: np.ndarray):
        self.parts, self.centres, self.radii = [], [], []
        for k in range(BLOCKS):
            p = y[:, bounds[k] : bounds[k + 1]]
            square = (p * p).sum(axis=1, keepdims=True)
            self.parts.append((np.hstack([-2 * p, square, np.ones_like(square)]).astype(np.float32), np.hstack([p, np.ones_like(square), square]).astype(np.float32)))
            self.centres.append(p.mean(axis=0))
            self.radii.append(float(np.sqrt(((p - self.centres[k]) ** 2).sum(axis=1).max())))

    def candidates(self, other: Chunk, budget: np.ndarray) -> np.ndarray | None:
        """Which pairs of rows keep within the budget in one block or more; none where no block lets them."""
        found = None
        for k in range(BLOCKS):
            apart = np.sqrt(((self.centres[k] - other.centres[k]) ** 2).sum()) - self.radii[k] - other.radii[k]
            if apart > np.sqrt(budget[k]) + SLACK:
                continue
            near = self.parts[k][0] @ other.parts[k][1].T <= np.float32(budget[k] + SINGLE_SLACK)
            found = near if found is None else np.logical_or(found, near, out=found)
        return found


def verified(x: np.ndarray, z: np.ndarray, near: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Of the candidate pairs of rows of ``x`` and ``z``, those of cosine ``least`` or more, by sums in double precision."""
    one = lambda u, v: (x[u] * z[v]).sum(axis=1) >= least
    if near.mean() < DENSE:
        u, v = np.nonzero(near)
        ok = np.concatenate([one(u[s : s + 20_000], v[s : s + 20_000]) for s in range(0, len(u), 20_000)]) if len(u) else np.zeros(0, bool)
        return u[ok], v[ok]
    cosine = x @ z.T
    u, v = np.nonzero(near & (cosine >= least - CLOSE))
    close = np.flatnonzero(cosine[u, v] < least + CLOSE)
    ok = np.ones(len(u), bool)
    ok[close] = one(u[close], v[close])
    return u[ok], v[ok]


def link_groups(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = 0.9) -> DataFrame:
    """``(id, n_links, component_id, kept)``, one row for each id; links are pairs with cosine >= ``least`` (above 0).

    Null and zero vectors and those with a null or non-finite component link with nothing. Shorter
    vectors are padded with zeros. Repeated ids count once, with their smallest vector; null ids are
    left out; other columns are ignored. No rows give no rows.
    """
    vectors = clean_vectors(df, id_col, vec_col).withColumns({"h": F.xxhash64("v"), "g": F.xxhash64(F.reverse("v"))})
    vectors = materialize(vectors.withColumn("some", F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))))
    dim = max(int(vectors.agg(F.max(F.size("v"))).first()[0] or 0), BLOCKS)
    single = dict(vectors.dtypes)["v"] == "array<float>"
    bounds = np.linspace(0, dim, BLOCKS + 1).astype(int)
    budget = (2 - 2 * least) * np.diff(bounds) / dim + SLACK
    turn, _ = np.linalg.qr(np.random.default_rng(3).standard_normal((dim, dim)))

    folds = materialize(vectors.where("some").groupBy("h", "g").agg(F.min("id").alias("rep"), F.count("*").alias("copies")))
    repeated = materialize(folds.where("copies > 1"))
    n = folds.count()
    # the copies are few rows or many; either way each fold keeps its smallest id
    marked = vectors.where("some").select("id", "v", "h", "g").join(small(repeated), ["h", "g"], "left")
    kept = marked.where("rep is null or rep = id").select("id", F.coalesce("copies", F.lit(1).cast("long")).alias("copies"), "v")
    size = min(TILE, max(1, -(-n // LEAST_GROUPS)))
    sample = vectors.where("some").select("id", "v").orderBy(F.xxhash64("id"), "id").limit(min(PIVOTS, max(1, -(-n // size)))).toPandas()["v"]
    pivots, _ = unit(sample, dim)
    pivots = pivots @ turn
    cuts = [slice(bounds[k], bounds[k + 1]) for k in range(BLOCKS)]

    def cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            y = unit(f["v"], dim)[0] @ turn
            home = (y @ pivots.T).argmax(axis=1) if len(y) else np.zeros(0, int)
            away = {f"r{k}": np.sqrt(((y[:, c] - pivots[home][:, c]) ** 2).sum(axis=1)) for k, c in enumerate(cuts)}
            raw = [np.asarray(v, np.float32 if single else np.float64).tobytes() for v in f["v"]]
            yield pd.DataFrame({"cell": home, "id": f["id"], "copies": f["copies"], "x": raw, **away})

    radii = [f"r{k}" for k in range(BLOCKS)]
    dealt = materialize(kept.mapInPandas(cells, "cell int, id long, copies long, x binary, " + ", ".join(f"{r} double" for r in radii)))
    # a row for each pivot
    known = dealt.groupBy("cell").agg(F.count("*").alias("n"), *[F.max(r).alias(r) for r in radii]).orderBy("cell").toPandas()
    salts = np.maximum(1, -(-known["n"].to_numpy(np.int64) // size)) if len(known) else np.zeros(0, np.int64)
    first = dict(zip(known["cell"].tolist(), (np.cumsum(salts) - salts).tolist(), strict=True))
    salted = dict(zip(known["cell"].tolist(), salts.tolist(), strict=True))
    spots, reach = pivots[known["cell"].to_numpy(int)], known[radii].to_numpy()

    def partners(cell: int) -> np.ndarray:
        """Groups that may hold links of a cell's rows."""
        at = list(first).index(cell)
        ok = np.zeros(len(spots), bool)
        for k, c in enumerate(cuts):
            ok |= np.sqrt(((spots[:, c] - spots[at, c]) ** 2).sum(axis=1)) - reach[:, k] - reach[at, k] <= np.sqrt(budget[k]) + SLACK
        return np.concatenate([np.arange(first[c], first[c] + salted[c]) for c, good in zip(first, ok, strict=True) if good])

    def tiles(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for cell, rows in f.groupby("cell"):
                own = first[cell] + rows["group"].to_numpy()
                for other in partners(cell).tolist():
                    yield pd.DataFrame({"i": np.minimum(own, other), "j": np.maximum(own, other), "group": own, "id": rows["id"].to_numpy(), "copies": rows["copies"].to_numpy(), "x": rows["x"].to_numpy()})

    many = F.create_map(*[F.lit(v) for c, k in salted.items() for v in (c, k)]) if salted else F.create_map(F.lit(0), F.lit(1))
    groups = dealt.select("cell", "id", "copies", "x", F.pmod(F.xxhash64("id"), many[F.col("cell")]).alias("group"))
    around = groups.mapInPandas(tiles, "i int, j int, group int, id long, copies long, x binary")

    def meet(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["group", "id"]).reset_index(drop=True)
        x, _ = unit([np.frombuffer(v, np.float32 if single else np.float64) for v in f["x"]], dim)
        y = x @ turn
        # rows near one another are put side by side, so that chunks are small balls
        near = y[:: max(1, len(y) // 256)]
        order = np.lexsort(((y @ near.T).argmax(axis=1), f["group"].to_numpy()))
        x, y, ids, copies, group = x[order], y[order], f["id"].to_numpy()[order], f["copies"].to_numpy()[order], f["group"].to_numpy()[order]
        split = int((group == key[0]).sum()) if key[0] != key[1] else len(f)
        left = [(a, min(a + 2048, split)) for a in range(0, split, 2048)]
        right = [(a, min(a + 2048, len(f))) for a in range(split, len(f), 2048)] if key[0] != key[1] else left
        chunks = {a: Chunk(y[a:b], bounds) for a, b in {*left, *right}}
        links, root, edges = np.zeros(len(f), np.int64), np.arange(len(f)), []
        for a, b in left:
            for c, e in right:
                if key[0] == key[1] and c < a:
                    continue
                found = chunks[a].candidates(chunks[c], budget)
                if found is None:
                    continue
                if a == c:
                    found = np.triu(found, 1)
                u, v = verified(x[a:b], x[c:e], found, least)
                u, v = u + a, v + c
                links += np.bincount(u, copies[v], len(f)).astype(np.int64) + np.bincount(v, copies[u], len(f)).astype(np.int64)
                new = forest(u, v, root)
                edges.append((ids[u[new]], ids[v[new]]))
        some = links > 0
        src, dst = (np.concatenate([e[s] for e in edges]) if edges else np.zeros(0, np.int64) for s in (0, 1))
        counts = pd.DataFrame({"a": ids[some], "n": links[some]})
        return pd.concat([counts.assign(b=pd.array([None] * len(counts), "Int64")), pd.DataFrame({"a": src, "b": pd.array(dst, "Int64"), "n": 0})])[["a", "b", "n"]]

    found = materialize(around.groupBy("i", "j").applyInPandas(meet, "a long, b long, n long"))
    counts = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))
    components = connected_components(found.where("b is not null").select(F.col("a").alias("src"), F.col("b").alias("dst"))).toDF("rep", "component")
    # what holds of the vector that stands for equal ones holds of each of them, which are linked with one another too
    told = folds.join(counts, "rep", "left").join(components, "rep", "left")
    told = told.select("h", "g", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component")).where("n_links > 0")
    ids = vectors.select("id", F.when(F.col("some"), F.col("h")).alias("h"), "g")
    return ids.join(told, ["h", "g"], "left").select("id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component", "id").alias("component_id")).withColumn("kept", F.col("id") == F.col("component_id"))
