"""Token ids in directly addressable codes (operator 13).

Ids are split into chunks, low bits first. The first chunks of all ids lie together in level 0, the second
chunks of those ids that have one in level 1, and so on. A bitmap beside each level tells which chunks go
on, and a rank directory how many do before each block of it, so that any token, or any run of tokens, is
read from a few bytes of each level and nothing before it is decoded. Chunk widths are the ones that make
the file smallest.

A file holds documents in ascending order of id, and says where each ends:

    header   magic, documents, tokens, levels
    levels   width, chunks, places of chunks, bitmap and rank directory (one row each)
    ids      document ids, 8 bytes each; one bit each that says whether the id is known; ends, 8 bytes each
    data     chunks, bitmap and directory of each level

Tasks write files under names of their own to the shared folder; the table of contents, which Spark
commits, says which of them count.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracelake.llm.common import materialize, shared_dir, slices, small
from tracelake.llm.warc import opened
from tracelake.llm.words import LowerWords, Remembered, release, vocabulary

FILE_TOKENS = 1 << 20  # tokens after which a file is closed; a longer document has a file of its own
TASK_BYTES = 1 << 26  # bytes of text that a task encodes and writes, about
RUN = 1 << 18  # tokens that are packed or decoded together
BLOCK = 512  # bits of a bitmap for each entry of its rank directory
MAGIC = b"DACODES1"
HEADER, LEVEL = "<8sQQQ", "<QQQQQ"
CONTENTS = "file string, part int, seq int, n_docs long, n_tokens long"


def widths(ids: np.ndarray) -> list[int]:
    """Chunk widths that take the fewest bits: each level but the last costs its width and a bit of the bitmap for every chunk."""
    lengths = np.bincount(np.frexp(np.maximum(ids, 1).astype(np.float64))[1], minlength=2)
    top = int(np.flatnonzero(lengths)[-1]) if len(ids) else 1
    longer = len(ids) - np.cumsum(lengths)  # ids of more bits than the index
    longer[0] = len(ids)
    cost, width = [0] * (top + 1), [0] * (top + 1)
    for low in range(top - 1, -1, -1):  # bits from low on
        every = [(int(longer[low]) * (high - low + (high < top)) + cost[high], high - low) for high in range(low + 1, top + 1)]
        cost[low], width[low] = min(every)
    out, low = [], 0
    while low < top:
        out.append(width[low])
        low += width[low]
    return out


def pack(values: np.ndarray, width: int) -> bytes:
    """``width`` bits of each value, low bits first."""
    rows = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4)
    return b"".join(np.packbits(np.unpackbits(rows[k : k + RUN], axis=1, count=width, bitorder="little"), bitorder="little").tobytes() for k in range(0, len(rows), RUN))


def unpacked(bits: np.ndarray) -> np.ndarray:
    """Values of rows of bits, low bits first."""
    whole = np.zeros((len(bits), 32), np.uint8)
    whole[:, : bits.shape[1]] = bits
    return np.packbits(whole, axis=1, bitorder="little").view("<u4")[:, 0].astype(np.uint32)


def coded(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """A file of documents, whose ids lie one after the other in ``ids``."""
    levels, rest = [], ids.astype(np.uint32)
    sizes = widths(rest)
    for width in sizes:
        more = (rest >> np.uint32(width)) > 0
        ranks = np.concatenate([[0], np.cumsum(np.add.reduceat(more, np.arange(0, len(more), BLOCK)) if len(more) else [])]).astype("<u8")
        levels.append((width, len(rest), pack(rest & np.uint32((1 << width) - 1), width), np.packbits(more, bitorder="little").tobytes(), ranks.tobytes()))
        rest = rest[more] >> np.uint32(width)
    known = np.array([i is not None for i in doc_ids], bool)
    table = np.array([i or 0 for i in doc_ids], "<i8").tobytes() + np.packbits(known, bitorder="little").tobytes() + np.cumsum(lengths).astype("<u8").tobytes()
    at = struct.calcsize(HEADER) + struct.calcsize(LEVEL) * len(levels) + len(table)
    rows, data = [], []
    for width, n, *parts in levels:
        places = []
        for part in parts:
            places.append(at)
            at += len(part)
        rows.append(struct.pack(LEVEL, width, n, *places))
        data += parts
    return b"".join([struct.pack(HEADER, MAGIC, len(doc_ids), len(ids), len(levels)), *rows, table, *data])


class Codes:
    """A coded file; ``read(size, place)`` gives bytes of it."""

    def __init__(self, read: Callable[[int, int], bytes]):
        self.read = read
        start, row = struct.calcsize(HEADER), struct.calcsize(LEVEL)
        magic, self.n_docs, self.n_tokens, n = struct.unpack(HEADER, read(start, 0))
        if magic != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        self.levels = list(struct.iter_unpack(LEVEL, read(row * n, start)))
        self.table = start + row * n

    def documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, whether each is known, and where each document ends."""
        n, bits = self.n_docs, -(-self.n_docs // 8)
        ids = np.frombuffer(self.read(8 * n, self.table), "<i8")
        known = np.unpackbits(np.frombuffer(self.read(bits, self.table + 8 * n), np.uint8), bitorder="little")[:n].astype(bool)
        return ids, known, np.frombuffer(self.read(8 * n, self.table + 8 * n + bits), "<u8").astype(np.int64)

    def bits(self, place: int, width: int, start: int, stop: int) -> np.ndarray:
        """Values ``start`` to ``stop`` of a packed row."""
        first, last = start * width // 8, -(-stop * width // 8)
        row = np.unpackbits(np.frombuffer(self.read(last - first, place + first), np.uint8), bitorder="little")
        return row[start * width - 8 * first :][: (stop - start) * width].reshape(-1, width)

    def tokens(self, start: int, stop: int, level: int = 0) -> np.ndarray:
        """Chunks ``start`` to ``stop`` of a level with all that follow them; of level 0, tokens."""
        width, _, chunks, bitmap, ranks = self.levels[level] if self.levels else (1, 0, 0, 0, 0)
        if stop <= start:
            return np.zeros(0, np.uint32)
        out = unpacked(self.bits(chunks, width, start, stop))
        if level + 1 < len(self.levels):
            block = start // BLOCK
            near = self.bits(bitmap, 1, block * BLOCK, stop)[:, 0].astype(bool)
            skip = start - block * BLOCK
            first = int.from_bytes(self.read(8, ranks + 8 * block), "little") + int(near[:skip].sum())
            more = near[skip:]
            out[more] |= self.tokens(first, first + int(more.sum()), level + 1) << np.uint32(width)
        return out


def order(id_col: Column, text: Column) -> list[Column]:
    """Documents by id, null ids last, repeated ids by their text's hash."""
    return [id_col.asc_nulls_last(), F.xxhash64(text).asc()]


def encoded(texts: list[str], memory: Remembered, encode: LowerWords, end: int) -> list[bytes]:
    """Ids of each text and the end id; words are cut at ASCII white space, which no token holds."""
    words = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
    known = memory.learn(words, encode)
    close = struct.pack("<I", end)
    return [b"".join([*map(known.__getitem__, some), close]) for some in words]


def write_codes(docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end: int = 2) -> tuple[str, DataFrame]:
    """Encode all documents and write them in ascending order of id; returns the folder and the table of contents.

    ``path`` is a tokenizer file of the tokenizers library whose pre-tokens hold no white space. Null and
    empty texts have the end id alone. Null ids come last, and rows of the same id in the order of their
    texts' hashes; repeated rows repeat. Other columns play no part. No rows give no files. The contents
    are ``file, part, seq, n_docs, n_tokens, start``: files in order of (part, seq), and the number of
    tokens before each.
    """
    path = path or vocabulary("word_bpe_49k.json")
    folder = folder or f"{shared_dir(docs.sparkSession)}/codes-{uuid.uuid4().hex}"
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    keys = order(F.col("id"), F.col("text"))
    ordered = rows.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, encode, part = Remembered(), LowerWords(path), TaskContext.get().partitionId()
        store, base = opened(folder)
        store.create_dir(base, recursive=True)
        ids, blobs, size, seq = [], [], 0, 0

        def close() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.dac"
            with store.open_output_stream(f"{base}/{name}", compression=None) as f:
                f.write(coded(ids, [len(b) // 4 for b in blobs], np.frombuffer(b"".join(blobs), "<u4")))
            columns = [pa.array([name]), pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([size], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in CONTENTS.split(", ")])

        for batch in batches:
            for some in slices([batch], 100):
                for i, blob in zip(some.column("id").to_pylist(), encoded(some.column("text").to_pylist(), memory, encode, end), strict=True):
                    if blobs and size + len(blob) // 4 > FILE_TOKENS:
                        yield close()
                        ids, blobs, size, seq = [], [], 0, seq + 1
                    ids.append(i)
                    blobs.append(blob)
                    size += len(blob) // 4
        if blobs:
            yield close()
        del memory, encode, ids, blobs
        release()

    contents = materialize(ordered.mapInArrow(run, CONTENTS))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = contents.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row a task
    parts = parts.select("part", before(Window.orderBy("part")).alias("base"))
    within = contents.withColumn("n", F.col("n_tokens")).withColumn("within", before(Window.partitionBy("part").orderBy("seq"))).drop("n")
    starts = within.join(small(parts), "part").withColumn("start", F.col("base") + F.col("within"))
    return folder, materialize(starts.select("file", "part", "seq", "n_docs", "n_tokens", "start"))


def dealt(contents: DataFrame) -> DataFrame:
    """The table of contents with its files dealt to tasks."""
    n, cores = contents.count(), contents.sparkSession.sparkContext.defaultParallelism
    return contents.repartition(max(1, min(n, max(2 * cores, n // 8))), "file")


def read_codes(folder: str, contents: DataFrame, tokens: bool = True) -> DataFrame:
    """Every document of the files: ``doc_id, start, n_tokens, ids_crc32`` and, with ``tokens``, ``ids``. A task decodes so many documents as fill ``RUN`` tokens, or one, at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(folder)
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with store.open_input_file(f"{base}/{name}") as file:
                    codes = Codes(file.read_at)
                    doc_ids, known, ends = codes.documents()
                    begins, k = np.concatenate([[0], ends[:-1]]), 0
                    while k < len(ends):
                        n = max(k + 1, int(np.searchsorted(ends, begins[k] + RUN, "right")))
                        ids = codes.tokens(int(begins[k]), int(ends[n - 1])).astype("<u4")
                        bounds = np.append(begins[k:n], ends[n - 1]) - begins[k]
                        raw, cuts = memoryview(ids.tobytes()), (4 * bounds).tolist()
                        columns = [pa.array(doc_ids[k:n], pa.int64(), mask=~known[k:n]), pa.array(start + begins[k:n]), pa.array(np.diff(bounds)), pa.array([zlib.crc32(raw[a:b]) for a, b in zip(cuts, cuts[1:])], pa.int64())]  # noqa: B905
                        if tokens:
                            columns.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int64))))
                        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * tokens])
                        k = n

    return dealt(contents).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * tokens)


def tokens_at(folder: str, contents: DataFrame, positions: DataFrame) -> DataFrame:
    """``positions(position)`` with ``token``: the id at each place among all tokens. Each is read by itself, without its neighbours.

    Places join files by blocks of ``FILE_TOKENS`` places. Null places and those beyond the end have no token and
    no row; repeated ones repeat.
    """
    block = lambda c: F.expr(f"{c} div {FILE_TOKENS}")
    files = contents.where("n_tokens > 0").select("file", "start", "n_tokens", F.explode(F.sequence(block("start"), block("(start + n_tokens - 1)"))).alias("block"))
    asked = positions.select(F.col("position").cast("long").alias("position")).withColumn("block", block("position"))
    found = asked.join(files, "block").where("position >= start and position < start + n_tokens").select("file", "position", (F.col("position") - F.col("start")).alias("at"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = opened(folder)
        for f in frames:
            for name, some in f.groupby("file"):
                with store.open_input_file(f"{base}/{name}") as file:
                    codes = Codes(file.read_at)
                    yield pd.DataFrame({"position": some["position"], "token": [int(codes.tokens(i, i + 1)[0]) for i in some["at"]]})

    return found.mapInPandas(run, "position long, token long")


def inspect(spark: SparkSession, docs: DataFrame, **kw) -> DataFrame:
    """What the files written from ``docs`` hold: ``doc_id, start, n_tokens, ids_crc32``."""
    return read_codes(*write_codes(docs, **kw), tokens=False)
