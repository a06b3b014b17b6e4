"""Alignment of two tokenizers' ids over the same bytes (operator 12).

Both tokenizers encode each whole text. Where a token of each ends at the same byte and the next token of
each begins with a space, the text is cut: such anchors are found by the tokens' lengths, and checked on
both sides. Between two anchors lies a window, a few ids of either; what follows from a window depends on
its ids alone, so that it is worked out once for each tuple of ids and remembered.

Tokens that end together close a group. All pairs of a group are links; they are counted by their ids,
never written one by one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import materialize, slices
from tracelake.llm.words import TOGETHER, Remembered, blobs, library, release, vocabulary

PART = 1 << 18  # characters of text that a worker aligns together
KEPT = 80_000  # windows that a worker remembers, about
KEPT_WORDS = 1 << 21  # characters of words whose ids a worker keeps, about; as many again are older
SPELLED = 256  # links of a group whose pairs are written out before they are counted
FEW = 2_000_000  # id pairs that are broadcast
#: Neither tokenizer reaches across a space that follows something else and stands before a word.
CUT = re.compile(r"(?<=[^ ]) (?=\S)")


def bytes_of_bytelevel(path: str) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary: printable characters stand for themselves, the other bytes, in order, for 256 and up."""
    from tokenizers import Tokenizer

    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    vocab = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        out[i] = bytes(byte_of[c] for c in piece) if all(c in byte_of for c in piece) else piece.encode()
    return out


def bytes_of_pieces(processor) -> list[bytes]:
    """Bytes of each id of a piece vocabulary: a piece's UTF-8 with U+2581 as space, or the byte that it names."""
    pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if processor.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]


class Side:
    """One tokenizer: ids of texts, and of each id its length in bytes and whether it begins with a space."""

    def __init__(self, encode: Callable[[list[str], list[int]], list[bytes]], spelled: list[bytes]):
        self.encode, self.spelled = encode, spelled
        self.length = np.array([len(b) for b in spelled], np.int64)
        self.marked = np.array([b[:1] == b" " for b in spelled])

    def exact(self, raw: bytes, ids: bytes) -> bool:
        """Whether ids spell these bytes."""
        return b"".join(map(self.spelled.__getitem__, np.frombuffer(ids, "<u4").tolist())) == raw

    def exact_parts(self, raw: bytes, ends: list[int], found: list[bytes]) -> bool:
        """Whether the ids of each part spell it: all bytes agree, and parts end where they should."""
        ids = b"".join(found)
        stops = np.concatenate([[0], np.cumsum(self.length[np.frombuffer(ids, "<u4")])])[np.cumsum([len(b) for b in found]) // 4]
        return stops.tolist() == ends and self.exact(raw, ids)


def octets(text: str) -> int:
    """Length in UTF-8."""
    return len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass"))


def together(encode: Callable[[list[str]], list[list[int]]], length: np.ndarray, parts: list[str], sizes: list[int]) -> list[bytes]:
    """Byte-level ids of each part after its space, ``sizes`` bytes. Parts that begin with a word are handed over as one text, since no token reaches across; bytes tell where each ends."""
    out = [b""] * len(parts)
    plain, rest = [], []
    for k, p in enumerate(parts):
        (plain if p and not p[0].isspace() else rest).append(k)
    for k, ids in zip(rest, blobs(encode([" " + parts[k] for k in rest])), strict=True):
        out[k] = ids
    texts = [parts[k] for k in plain]
    ids = np.fromiter(chain.from_iterable(encode([" " + " ".join(texts[at : at + TOGETHER]) for at in range(0, len(texts), TOGETHER)])), "<u4")
    raw, ends = ids.tobytes(), (4 * np.searchsorted(np.cumsum(length[ids]), np.cumsum([sizes[k] for k in plain])) + 4).tolist()
    for k, start, end in zip(plain, [0, *ends], ends, strict=False):
        out[k] = raw[start:end]
    return out


def sides(path_a: str, path_b: str) -> tuple[Side, Side]:
    """The byte-level tokenizer, given a part with the space before it, and the piece tokenizer, which adds that space."""
    import sentencepiece

    encode, pieces, spelled = library(path_a, plain=True), sentencepiece.SentencePieceProcessor(model_file=path_b), bytes_of_bytelevel(path_a)
    length = np.array([len(b) for b in spelled], np.int64)
    return Side(lambda parts, sizes: together(encode, length, parts, sizes), spelled), Side(lambda parts, sizes: blobs(pieces.encode(parts, num_threads=1)), bytes_of_pieces(pieces))


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` for each row, ``count`` of them, one after the other."""
    return np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())


class Rows:
    """Arrays of any length one after the other, and where each begins; grows by doubling."""

    def __init__(self, width: int = 1):
        self.flat, self.ends, self.n, self.used = np.zeros((1024, width), np.int64), np.zeros(1024, np.int64), 0, 0

    def extend(self, flat: np.ndarray, counts: np.ndarray) -> None:
        for name, room in (("flat", self.used + len(flat)), ("ends", self.n + len(counts) + 1)):
            old = getattr(self, name)
            if room > len(old):
                setattr(self, name, np.concatenate([old, np.zeros((2 * room - len(old), *old.shape[1:]), np.int64)]))
        self.flat[self.used : self.used + len(flat)] = flat
        self.ends[self.n + 1 : self.n + 1 + len(counts)] = self.used + np.cumsum(counts)
        self.used, self.n = self.used + len(flat), self.n + len(counts)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arrays of these rows one after the other, and how long each is."""
        counts = self.ends[rows + 1] - self.ends[rows]
        return self.flat[ranges(self.ends[rows], counts)], counts


class Windows:
    """What follows from a window's ids: its number, and by number the text of its groups, their sizes, and its links counted by id pair.

    New windows are worked out many at a time, as if their ids were one text's.
    """

    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        most = max(len(a.spelled), len(b.spelled))
        self.shift = most.bit_length()  # an id pair is one number
        self.strings = [mark + str(i) for mark in ("", ",", "|", ";") for i in range(most)]
        self.most = most
        self.forget()

    def forget(self) -> None:
        self.known, self.text, self.sizes, self.pairs = {}, [], Rows(2), Rows(2)

    def learn(self, new: list[tuple[bytes, bytes]]) -> None:
        """Number windows that aren't known yet."""
        a, b = (np.frombuffer(b"".join([k[s] for k in new]), "<u4").astype(np.int64) for s in (0, 1))
        n_a, n_b = (np.array([len(k[s]) for k in new], np.int64) // 4 for s in (0, 1))
        end_a, end_b = np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b])
        at = np.searchsorted(end_b, end_a)
        shared = np.flatnonzero(end_b[at] == end_a)  # the last ids end together
        last_a, last_b = shared + 1, at[shared] + 1
        size_a, size_b = np.diff(last_a, prepend=0), np.diff(last_b, prepend=0)
        start_a, start_b = last_a - size_a, last_b - size_b
        groups = np.diff(np.searchsorted(last_a, np.cumsum(n_a)) + 1, prepend=0)  # of each window
        window = np.repeat(np.arange(len(new)), groups)
        self.sizes.extend(np.stack([size_a, size_b], 1), groups)
        self.count(a, b, start_a, start_b, size_a, size_b, window, len(new))
        # ids in the order of the text, and what stands before each
        of_a, of_b = np.repeat(np.arange(len(shared)), size_a), np.repeat(np.arange(len(shared)), size_b)
        mark_a, mark_b = np.ones(len(a), np.int64), np.ones(len(b), np.int64)
        mark_a[start_a], mark_b[start_b] = 3, 2
        mark_a[np.cumsum(n_a) - n_a] = 0
        order = np.argsort(np.concatenate([2 * of_a, 2 * of_b + 1]), kind="stable")
        items = list(map(self.strings.__getitem__, np.concatenate([mark_a * self.most + a, mark_b * self.most + b])[order].tolist()))
        ends = np.cumsum(n_a + n_b).tolist()
        self.text += ["".join(items[i:j]) for i, j in zip([0, *ends], ends, strict=False)]
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))

    def count(self, a, b, start_a, start_b, size_a, size_b, window, n: int) -> None:
        """Links of each window by id pair. Pairs of a large group are counted from those of its distinct ids."""
        links = size_a * size_b
        few = np.flatnonzero(links <= SPELLED)
        group = np.repeat(few, links[few])
        k = ranges(np.zeros(len(few), np.int64), links[few])
        found = [(window[group], a[start_a[group] + k // size_b[group]] << self.shift | b[start_b[group] + k % size_b[group]], np.ones(len(group), np.int64))]
        for g in np.flatnonzero(links > SPELLED).tolist():
            (x, m), (y, l) = (np.unique(ids[i : i + s], return_counts=True) for ids, i, s in ((a, start_a[g], size_a[g]), (b, start_b[g], size_b[g])))
            codes = (x[:, None] << self.shift | y).ravel()
            found.append((np.full(len(codes), window[g]), codes, (m[:, None] * l).ravel()))
        where, codes, times = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(where, kind="stable")
        self.pairs.extend(np.stack([codes[order], times[order]], 1), np.bincount(where, minlength=n))

    def numbers(self, texts: list[list[tuple[bytes, bytes]]]) -> list[list[int]]:
        """Numbers of the windows of each text."""
        if len(self.known) > KEPT:
            self.forget()
        get = self.known.get
        out = [[get(k) for k in some] for some in texts]
        new = list(dict.fromkeys(k for some, told in zip(texts, out, strict=True) if None in told for k, n in zip(some, told, strict=True) if n is None))
        if new:
            self.learn(new)
            out = [[self.known[k] if n is None else n for k, n in zip(some, told, strict=True)] if None in told else told for some, told in zip(texts, out, strict=True)]
        return out


class Aligner:
    """Aligns texts, remembering words and windows."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = sides(path_a, path_b)
        self.windows, self.memory = Windows(self.a, self.b), Remembered(KEPT_WORDS)

    def parts(self, parts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of each part by both tokenizers; none where they don't spell it after a space. All are looked at together first."""
        sizes = [1 + octets(p) for p in parts]
        a, b = self.a.encode(parts, sizes), self.b.encode(parts, sizes)
        raw, ends = (" " + " ".join(parts)).encode("utf-8", "surrogatepass"), np.cumsum(sizes).tolist()
        if self.a.exact_parts(raw, ends, a) and self.b.exact_parts(raw, ends, b):
            return list(zip(a, b, strict=True))
        spelled = lambda p, x, y: self.a.exact(p, x) and self.b.exact(p, y)
        return [(x, y) if spelled((" " + p).encode("utf-8", "surrogatepass"), x, y) else (b"", b"") for p, x, y in zip(parts, a, b, strict=True)]

    def ids(self, texts: list[list[str]]) -> Iterator[tuple[bytes, bytes]]:
        """Ids of each text by its parts, by both tokenizers; none where they don't spell it."""
        known = self.memory.learn(texts, self.parts)
        for parts in texts:
            a, b = zip(*[known[p] for p in parts], strict=True) if parts else ((), ())
            if not all(a):  # whether bytes of parts make up for each other is told by the whole text
                sizes, raw = [1 + octets(p) for p in parts], (" " + " ".join(parts)).encode("utf-8", "surrogatepass")
                a, b = self.a.encode(parts, sizes), self.b.encode(parts, sizes)
                if not self.a.exact(raw, b"".join(a)) or not self.b.exact(raw, b"".join(b)):
                    a = b = ()
            yield b"".join(a), b"".join(b)

    def anchors(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where windows begin and end, as counts of ids of A and of B: both ends included."""
        start_a, start_b = (np.concatenate([[0], np.cumsum(s.length[x])]) for s, x in ((self.a, a), (self.b, b)))
        at_a, at_b = (np.flatnonzero(s.marked[x]) for s, x in ((self.a, a), (self.b, b)))
        place = np.zeros(start_a[-1] + 1, np.int32)
        place[start_a[at_a]] = at_a + 1
        met = place[start_b[at_b]]  # number, from 1, of A's marked token that begins where B's does
        shared = (met > 1) & (at_b > 0)
        return np.concatenate([[0], met[shared] - 1, [len(a)]]), np.concatenate([[0], at_b[shared], [len(b)]])

    def align(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray, list[int]]]:
        """For each text its ids of A and B and the numbers of its windows; none for a text without tokens."""
        parts = [CUT.split(t) if t else [] for t in texts]
        ids, keys = [], []
        for raw_a, raw_b in self.ids(parts):
            a, b = np.frombuffer(raw_a, "<u4"), np.frombuffer(raw_b, "<u4")
            cut_a, cut_b = ((4 * x).tolist() for x in self.anchors(a, b)) if raw_a else ([], [])
            ids.append((a, b))
            keys.append([(raw_a[i:j], raw_b[m:n]) for i, j, m, n in zip(cut_a, cut_a[1:], cut_b, cut_b[1:])])  # noqa: B905
        return [(*x, numbers) for x, numbers in zip(ids, self.windows.numbers(keys), strict=True)]


def chunks(column: pa.Array) -> Iterator[list[str | None]]:
    """Texts of an Arrow column in order, in lists of about ``PART`` characters."""
    some, size = [], 0
    for cell in column:
        some.append(cell.as_py())
        size += len(some[-1] or "")
        if size >= PART:
            yield some
            some, size = [], 0
    if some:
        yield some


def offsets(lengths) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))


def listed(arrays: list[np.ndarray]) -> pa.ListArray:
    """A list column of one array a row."""
    return pa.ListArray.from_arrays(offsets([len(x) for x in arrays]), pa.array(np.concatenate(arrays).astype(np.int32)))


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None, spans: bool = True) -> DataFrame:
    """Each text encoded by a byte-level and a piece tokenizer, and the groups of tokens that cover the same bytes.

    ``id, n_a, n_b, n_groups, n_links, groups_sha256, pairs``: counts of tokens, groups and links, the hash of
    ``a1,a2|b1;a3|b2,b3``, and an array of ``(a, b, times)``, the links counted by id pair. With ``spans`` also
    ``a_ids, b_ids, a_ends, b_ends``: ids, and after how many of them each group ends. Texts that are null,
    empty or not spelled by both sides have zeros, an empty hash and empty arrays. Rows keep whatever ids
    they have; repeated rows repeat; other columns play no part; no rows give no rows.
    """
    path_a, path_b = path_a or vocabulary("byte_bpe_50k.json"), path_b or vocabulary("piece_bpe_32k.model")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        w = aligner.windows
        for batch in slices(batches):
            at = 0
            for texts in chunks(batch.column("text")):
                found = aligner.align(texts)
                size = np.array([len(n) for _, _, n in found])
                numbers, row = np.array([k for _, _, n in found for k in n], np.int64), np.repeat(np.arange(len(found)), size)
                each, groups = w.sizes.take(numbers)
                of_group = np.repeat(row, groups)
                total = lambda x, of: np.bincount(of, x, len(found)).astype(np.int64)  # noqa: B023, E731
                counts = [[len(a) for a, _, _ in found], [len(b) for _, b, _ in found], total(groups, row), total(each[:, 0] * each[:, 1], of_group)]
                hashes = [hashlib.sha256(";".join(map(w.text.__getitem__, n)).encode()).hexdigest() if n else "" for _, _, n in found]
                links, n_pairs = w.pairs.take(numbers)
                key, which = np.unique(np.repeat(row, n_pairs) << 2 * w.shift | links[:, 0], return_inverse=True)
                pairs = [key >> w.shift & (1 << w.shift) - 1, key & (1 << w.shift) - 1, np.bincount(which, links[:, 1], len(key))]
                struct = pa.StructArray.from_arrays([pa.array(x.astype(k)) for x, k in zip(pairs, (np.int32, np.int32, np.int64), strict=True)], ["a", "b", "times"])
                names = batch.column("id").slice(at, len(texts))
                at += len(texts)
                columns = [names, *(pa.array(c, pa.int64()) for c in counts), pa.array(hashes), pa.ListArray.from_arrays(offsets(np.bincount(key >> 2 * w.shift, minlength=len(found))), struct)]
                if spans:
                    n_groups = np.bincount(of_group, minlength=len(found))
                    columns += [listed([x[k] for x in found]) for k in (0, 1)]
                    parts = np.split(each, np.cumsum(n_groups)[:-1])
                    columns += [listed([np.cumsum(x[:, k]) for x in parts]) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in columns_of(spans).split("; ")])
        del aligner, w
        release()

    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, ", ".join(f"{c} {kind}" if c == "id" else c for c in columns_of(spans).split("; ")))


def columns_of(spans: bool) -> str:
    return "id; n_a long; n_b long; n_groups long; n_links long; groups_sha256 string; pairs array<struct<a:int,b:int,times:bigint>>" + "; a_ids array<int>; b_ids array<int>; a_ends array<int>; b_ends array<int>" * spans


def pair_counts(found: DataFrame) -> DataFrame:
    """``a, b, n, best``: how many rows of ``found(pairs)`` hold each linked id pair, and whether no pair of the same A id is held by more."""
    n = materialize(found.select(F.inline("pairs")).groupBy("a", "b").agg(F.count("*").alias("n")))
    most = n.groupBy("a").agg(F.max("n").alias("most"))
    return materialize(n.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best")))


def with_counts(links: DataFrame, counts: DataFrame, few: int = FEW) -> DataFrame:
    """``links(a, b, ...)`` with ``n, best``. At most ``few`` pairs are broadcast, those that most rows hold; the others, none of which is frequent, are joined by shuffling."""
    if counts.count() <= few:
        return links.join(F.broadcast(counts), ["a", "b"])
    common = materialize(counts.orderBy(F.desc("n"), "a", "b").limit(few))
    met = links.join(F.broadcast(common), ["a", "b"])
    rare = links.join(F.broadcast(common.select("a", "b")), ["a", "b"], "left_anti").join(counts.join(common, ["a", "b"], "left_anti"), ["a", "b"])
    return met.unionByName(rare)


def agreement(docs: DataFrame, few: int = FEW, **kw) -> DataFrame:
    """How far each text's links are those of the whole corpus: ``id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A pair's count is the number of texts that hold it linked. ``n_best``: links whose pair has the highest count of
    its A id's pairs, ties included; ``count_sum``: the sum of counts over links.
    """
    found = materialize(aligned(docs, spans=False, **kw).withColumn("row", F.monotonically_increasing_id()))
    links = found.select("row", F.inline("pairs"))
    counted = with_counts(links, pair_counts(found), few)
    sums = counted.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return found.drop("pairs").join(sums, "row", "left").select("id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
