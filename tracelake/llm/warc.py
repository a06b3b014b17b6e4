"""WARC records in seekable Zstandard bundles (operator 10).

A bundle is one file: records grouped in independent Zstandard frames of bounded size, closed by a
seek table (a skippable frame that lists each frame's compressed and plain size), so that any reader
of plain Zstandard unpacks it and a record is found by its frame and the offset within it. Tasks write
bundles straight to the shared folder under names of their own; the table of contents, which Spark
commits, says which files count, so a task that ran twice or was lost leaves nothing that is read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracelake.llm.common import materialize, shared_dir, small

FRAME = 1 << 18  # plain bytes after which a frame is closed
BUNDLE = 1 << 25  # compressed bytes after which a bundle is closed
LEVEL = 3
SEEKABLE = 0x8F92EAB1  # fixed values of the seekable format: its magic number and that of a skippable frame
SKIPPABLE = 0x184D2A5E
CONTENTS = "page_id long, file string, frame int, start long, size long, offset long, length long"
DATE = "2024-01-01T00:00:00Z"


def record(page_id: int, url: str, kind: str, digest: str, refers_to: int | None, length: int, payload: bytes) -> bytes:
    """One WARC/1.1 record; a revisit has an empty block and names the record it repeats."""
    block = b"" if kind == "revisit" else payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {''.join(c for c in url if c.isprintable())}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Payload-Length: {length}",
    ]
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers (names in lower case) and block of the record at a place, and the place of the next one."""
    end = raw.index(b"\r\n\r\n", at)
    lines = raw[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = raw[end + 4 : end + 4 + int(headers["content-length"])]
    return headers, block, end + 4 + len(block) + 4


#: Names that Hadoop and pyarrow give to the same stores (fixed values).
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfs": "abfss", "gcs": "gs"}


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The store that a folder's URI names, and the folder in it. Local paths, HDFS and the object stores that pyarrow knows are reached; its own settings (environment) hold for these."""
    scheme, colon, rest = folder.partition("://")
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}{colon}{rest}")


class Bundle:
    """Collects records into frames; ``close`` gives the file's bytes."""

    def __init__(self):
        self.frames, self.sizes, self.plain, self.rows = [], [], bytearray(), []
        self.written, self.name, self.pack = 0, f"{uuid.uuid4().hex}.warc.zst", zstandard.ZstdCompressor(level=LEVEL)

    def add(self, page_id: int, raw: bytes) -> None:
        if self.plain and len(self.plain) + len(raw) > FRAME:
            self.flush()
        self.rows.append((page_id, self.name, len(self.frames), len(self.plain), len(raw)))
        self.plain += raw

    def flush(self) -> None:
        if self.plain:
            frame = self.pack.compress(bytes(self.plain))
            self.frames.append(frame)
            self.sizes.append((len(frame), len(self.plain)))
            self.written += len(frame)
            self.plain = bytearray()

    def close(self) -> tuple[bytes, list[tuple]]:
        self.flush()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        starts, at = [], 0
        for size, _ in self.sizes:
            starts.append(at)
            at += size
        rows = [(p, name, k, starts[k], self.sizes[k][0], offset, length) for p, name, k, offset, length in self.rows]
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(table)) + table, rows


FOOTER = 9  # bytes at the end of a seek table: number of frames, flags, magic number


def seek_table(f) -> list[tuple[int, int, int]]:
    """``(start, compressed size, plain size)`` of each frame of an open file, from its last bytes alone."""
    end = f.size()
    n, flags, magic = struct.unpack("<IBI", f.read_at(FOOTER, end - FOOTER))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    step, out, at = 8 + 4 * bool(flags & 0x80), [], 0
    table = f.read_at(n * step, end - FOOTER - n * step)
    for k in range(n):
        size, plain = struct.unpack_from("<II", table, k * step)
        out.append((at, size, plain))
        at += size
    return out


def write_bundles(records: DataFrame, folder: str) -> DataFrame:
    """Write ``records(page_id, url, html, kind, digest, refers_to)`` below ``folder``; returns the table of contents.

    ``folder`` is a URI that all executors reach (a local path, or one pyarrow opens). The table lists
    for each record its file, frame, the frame's place in the file and the record's place in the frame.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = opened(folder)
        store.create_dir(base, recursive=True)
        columns = [c.split()[0] for c in CONTENTS.split(", ")]

        def close(bundle: Bundle) -> pd.DataFrame:
            data, rows = bundle.close()
            with store.open_output_stream(f"{base}/{bundle.name}", compression=None) as f:
                f.write(data)
            return pd.DataFrame(rows, columns=columns)

        bundle = Bundle()
        for f in frames:
            for r in f.itertuples(index=False):
                payload = (r.html or "").encode("utf-8", "surrogatepass")
                digest = base64.b32encode(bytes.fromhex(r.digest)).decode()
                refers = int(r.refers_to) if r.kind == "revisit" else None
                bundle.add(int(r.page_id), record(int(r.page_id), r.url or "", r.kind, digest, refers, len(payload), payload))
                if bundle.written >= BUNDLE:
                    yield close(bundle)
                    bundle = Bundle()
        if bundle.rows:
            yield close(bundle)

    return materialize(records.mapInPandas(run, CONTENTS))


def read_bundles(spark: SparkSession, folder: str, contents: DataFrame) -> DataFrame:
    """Every record of the bundles that ``contents`` lists: ``page_id, headers, block``.

    Names of bundles are dealt to tasks, which open them and read frame by frame through the seek tables: contents
    are never shuffled, and a task holds one frame at a time.
    """
    names = contents.select("file").distinct()
    names = names.repartition(max(1, min(10_000, names.count())), "file")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = opened(folder)
        for f in frames:
            for name in f["file"]:
                with store.open_input_file(f"{base}/{name}") as bundle:
                    for start, size, plain in seek_table(bundle):
                        raw, at, out = zstandard.ZstdDecompressor().decompress(bundle.read_at(size, start), max_output_size=plain), 0, []
                        while at < len(raw):
                            headers, block, at = parse(raw, at)
                            out.append((int(headers["warc-record-id"][len("<urn:page:") : -1]), headers, block))
                        yield pd.DataFrame(out, columns=["page_id", "headers", "block"])

    return names.mapInPandas(run, "page_id long, headers map<string,string>, block binary")


def fetch(folder: str, entry) -> tuple[dict[str, str], bytes]:
    """One record by its row of the table of contents: reads its frame only."""
    store, base = opened(folder)
    with store.open_input_file(f"{base}/{entry.file}") as f:
        frame = f.read_at(entry.size, entry.start)
    raw = zstandard.ZstdDecompressor().decompressobj().decompress(frame)
    return parse(raw, entry.offset)[:2]


def with_kinds(pages: DataFrame, least: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, html, kind, digest, refers_to``: of equal payloads of ``least`` bytes or more the smallest id is the response.

    A null html is an empty payload. Null ids are left out; of repeated ids the first by payload and url counts.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), html.alias("html"), F.sha1(F.encode(html, "UTF-8")).alias("digest"), F.octet_length(html).alias("bytes")).where("page_id is not null")
    heads = materialize(p.select("page_id", "digest", "bytes", F.coalesce("url", F.lit("")).alias("u")))
    if heads.count() != heads.agg(F.countDistinct("page_id")).first()[0]:
        p = p.withColumn("r", F.row_number().over(Window.partitionBy("page_id").orderBy("digest", "url"))).where("r = 1").drop("r")
        heads = materialize(p.select("page_id", "digest", "bytes"))
    first = heads.where(F.col("bytes") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    known = heads.where(F.col("bytes") >= least).join(first, "digest").where("page_id <> first").select("page_id", F.col("first").alias("refers_to"))
    p = p.join(small(materialize(known)), "page_id", "left")
    return p.withColumn("kind", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")).drop("bytes")


def archive(pages: DataFrame, folder: str | None = None, **kw) -> tuple[str, DataFrame]:
    """Write all pages as bundles; returns the folder and the table of contents."""
    folder = folder or f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    return folder, write_bundles(with_kinds(pages, **kw), folder)


def inspect(records: DataFrame) -> DataFrame:
    """What the archives say of each page: ``page_id, payload_bytes, payload_digest, record_type, refers_to``; a response's figures are taken from its payload."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for page_id, h, block in zip(f["page_id"], f["headers"], f["block"], strict=True):
                h = dict(h)
                digest, size = h["warc-payload-digest"][len("sha1:") :], int(h["warc-payload-length"])
                if h["warc-type"] == "response":
                    found = base64.b32encode(hashlib.sha1(block).digest()).decode()
                    if found != digest or len(block) != size:
                        raise ValueError(f"record {page_id} was damaged")
                refers = int(h["warc-refers-to"][len("<urn:page:") : -1]) if "warc-refers-to" in h else None
                out.append((page_id, size, digest, h["warc-type"], refers))
            f = pd.DataFrame(out, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
            yield f.assign(refers_to=f["refers_to"].astype("Int64"))

    return records.mapInPandas(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
