"""Language identification (operator 8).

Sparse multinomial logistic regression on TF-IDF character n-grams (code points of the lower-cased text,
anything but letters read as a space), trained with follow-the-regularised-leader and elastic-net
penalties on a bounded sample of documents, which reaches the driver as hashed sparse vectors (``BUCKETS``
entries at most); a temperature then calibrates its probabilities. Document frequencies cover all documents that may be
learned from.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import slices

BITS = 15
BUCKETS = 1 << BITS
SAMPLE = 3000  # documents that are trained on, about, shared equally by the languages: those of smallest hash
EPOCHS, RATE, LASSO, RIDGE = 2, 0.5, 0.02, 1e-4


def has_letter(text: str) -> bool:
    """Whether the text has a code point of a letter category."""
    return any(map(str.isalpha, text))


@cache
def letters() -> np.ndarray:
    """Which code points are letters or marks on them; made once a process."""
    return np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)), bool, 0x110000)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams (1 to 3) and how often they occur; anything but letters reads as a space."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.where(letters()[c], c, np.uint32(32)).astype(np.uint64)
    code, parts = c, []
    for n in (1, 2, 3):
        if n > 1:
            code = code[:-1] * np.uint64(1 << 21) + c[n - 1 :]
        mixed = (code ^ (code >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n * 0xD6E8FEB86659FD93 % (1 << 64))
        parts.append(mixed >> np.uint64(64 - BITS))
        if len(c) <= n:
            break
    counts = np.bincount(np.concatenate(parts).astype(np.int64), minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, n = grams(text)
    x = (1 + np.log(n)) * idf[at]
    return at, x / max(np.sqrt((x * x).sum()), 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Leader:
    """Follow-the-regularised-leader (proximal) for multinomial logistic regression."""

    def __init__(self, classes: int):
        self.z, self.n = np.zeros((classes, BUCKETS)), np.zeros((classes, BUCKETS))

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[:, at], self.n[:, at]
        return np.where(np.abs(z) <= LASSO, 0.0, -(z - np.sign(z) * LASSO) / ((1 + np.sqrt(n)) / RATE + RIDGE))

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        p = softmax(w @ x)
        p[y] -= 1
        g = p[:, None] * x[None]
        n = self.n[:, at]
        self.z[:, at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / RATE * w
        self.n[:, at] += g * g


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits under which the true languages are likeliest."""
    grid = np.geomspace(0.1, 5, 120)
    return float(grid[np.argmin([-np.log(softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid])])


def train(rows: DataFrame):
    """``(languages, weights, idf, temperature)`` from ``rows(id, text, lang)``, all of which may be learned from."""
    rows = rows.where("id is not null and text is not null and lang is not null")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs = np.zeros(BUCKETS, np.int64), 0
        for batch in slices(batches):
            for t in batch.column("text"):
                at, _ = grams(t.as_py()) if has_letter(t.as_py()) else (np.zeros(0, int), None)
                df[at] += 1
                docs += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *at.tolist()], pa.int32()), pa.array([docs, *df[at].tolist()], pa.int64())], ["bucket", "n"])

    df = rows.select("text").mapInArrow(frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    total = int(df.loc[df["bucket"] < 0, "n"].sum())
    df = df[df["bucket"] >= 0]
    idf = np.full(BUCKETS, np.log(1 + total) + 1)
    idf[df["bucket"]] = np.log((1 + total) / (1 + df["n"])) + 1

    sizes = rows.where(F.col("text").rlike(r"\p{L}")).groupBy("lang").agg(F.count("*").alias("rows")).toPandas()
    languages = sorted(sizes["lang"])
    index = {k: i for i, k in enumerate(languages)}
    share = max(1, SAMPLE // max(1, len(languages)))  # a language of no more documents than that keeps all of them
    chances = F.create_map(*[F.lit(x) for k, n in zip(sizes["lang"], sizes["rows"], strict=True) for x in (k, float(share / n))]) if languages else F.create_map(F.lit(""), F.lit(0.0))
    unit = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(unit < F.coalesce(F.try_element_at(chances, F.col("lang")), F.lit(0.0))).select("text", "lang", F.xxhash64("id", F.lit(4)).alias("place"), F.col("id").cast("string").alias("id"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text, lang, place, name in zip(*(batch.column(c) for c in ("text", "lang", "place", "id")), strict=True):
                if has_letter(text.as_py()):
                    at, x = vector(text.as_py(), idf)
                    out.append((place.as_py(), name.as_py(), lang.as_py(), at.astype(np.int32).tobytes(), x.astype(np.float32).tobytes()))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = (pa.int64(), pa.string(), pa.string(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["place", "id", "lang", "at", "x"])

    found = sample.mapInArrow(vectors, "place long, id string, lang string, at binary, x binary").toPandas().sort_values(["place", "id", "lang", "at", "x"])
    data = [((np.frombuffer(a, np.int32), np.frombuffer(x, np.float32).astype(float)), index[k]) for k, a, x in zip(found["lang"], found["at"], found["x"], strict=True)]
    held, used = data[::5], [d for i, d in enumerate(data) if i % 5]
    model = Leader(len(languages))
    for _ in range(EPOCHS):
        for (at, x), y in used:
            model.learn(at, x, y)
    weights = model.weights(slice(None))
    logits = np.array([weights[:, at] @ x for (at, x), _ in held])
    heat = temperature(logits, np.array([y for _, y in held])) if held else 1.0
    return languages, weights, idf, heat


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fold: int = 5) -> DataFrame:
    """``(id, held_out, lang_pred, score)``, one row for each row of ``docs``.

    Learned from documents whose ``crc32(id as text) mod fold`` is not 0; the others are held out.
    A row without id is neither held out nor learned from. Every language that has a text with letters is learned.
    ``und`` with score 0 where the text is null or has no letter, or where nothing could be learned.
    Repeated rows repeat; equal probabilities go to the first language by name; no rows give no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.withColumn("held_out", F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % fold == 0, F.lit(False)))
    languages, weights, idf, heat = train(rows.where(~F.col("held_out")))
    model = rows.sparkSession.sparkContext.broadcast((weights.astype(np.float32), idf))  # BUCKETS weights a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, idf = model.value
        for batch in slices(batches):
            names, scores = [], []
            for cell in batch.column("text"):
                text = cell.as_py()
                if not languages or not text or not has_letter(text):
                    names.append("und")
                    scores.append(0.0)
                    continue
                at, x = vector(text, idf)
                p = softmax(weights[:, at] @ x / heat)
                names.append(languages[int(p.argmax())])
                scores.append(float(p.max()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["id", "held_out", "lang_pred", "score"])

    kind = dict(rows.dtypes)["id"]
    return rows.select("id", "held_out", "text").mapInArrow(run, f"id {kind}, held_out boolean, lang_pred string, score double")
