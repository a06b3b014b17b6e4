"""SentencePiece encoding with N-best segmentations, and decoding (operator 6).

A text's pieces form a lattice. Forward Viterbi scores tell how good the best path to each place is;
they are exact heuristics for an A-star search backward from the end, which meets the segmentations
from best to worst. No piece crosses a word's start, so the lattice is a chain of words: words are
searched one by one (and remembered), and the N best of the text follow from the N-1 words whose
second choices cost least; any other word's second choice is worse than these N-1 changes.

The vocabulary file is a parameter. Its pieces are ranked by merges, without probabilities, so that a
piece's log-probability is taken as Zipf's law over its rank; characters outside the vocabulary are spelled
in bytes. Texts are kept exactly: no normalisation but the leading space, which decoding takes off.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from bisect import insort
from collections.abc import Iterator
from functools import lru_cache
from math import inf, log
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import slices

SPACE = "▁"
SHIFT = 2.7  # Zipf-Mandelbrot shift of the ranks
BYTE_COST = 2.0  # a byte piece is this much less likely than the rarest piece
REMEMBER = 200_000  # words a worker remembers
REMEMBER_CHARS = 5_000_000  # and their characters
LONG = 1_000  # characters of a word whose alternatives aren't remembered
TOGETHER = 40  # words up to this many characters are scored many at a time
BATCH = 5_000  # words that are scored at a time
PART = 300_000  # characters that are split into words at a time


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Pieces with ids and log-probabilities; small enough (tens of thousands) to travel with the tasks."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = sp.get_piece_size()
        self.surface = [b""] * size
        self.bytes = [0] * 256
        normal = []
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.surface[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                piece = piece.replace(SPACE, " ")
                self.surface[i] = piece.encode()
                normal.append((piece, i))
        norm = log(sum(1 / (r + SHIFT) for r in range(len(normal))))
        self.pieces = {p: (i, -log(r + SHIFT) - norm) for r, (p, i) in enumerate(normal)}
        self.byte_score = -log(len(normal) + SHIFT) - norm - BYTE_COST
        self.longest = max(len(p) for p in self.pieces)
        # with False for what only ends a piece
        self.endings = {p[k:]: False for p in self.pieces for k in range(1, len(p))} | self.pieces
        self.ids_of = [np.array([i], np.int32).tobytes() for i in range(size)]
        known = {c for p in self.pieces for c in p} - {" "}
        if any(re.search(r"[^ ] ", p) for p in self.pieces):
            raise ValueError("pieces that cross a word's start aren't supported")
        # a word with the spaces before it; spaces alone; a character outside the vocabulary
        some = "".join(map(re.escape, sorted(known)))
        self.words = f" *[{some}]+| +|[^ {some}]"
        self.plant(normal)

    def plant(self, pieces: list[tuple[str, int]]) -> None:
        """The pieces as a trie in arrays: sorted keys (node and character) and the nodes they lead to, and each node's piece and log-probability."""
        steps: dict[tuple[int, int], int] = {}
        at_node: dict[int, int] = {}
        for piece, i in pieces:
            node = 0
            for c in piece:
                node = steps.setdefault((node, ord(c)), len(steps) + 1)
            at_node[node] = i
        keys = sorted((node << 21 | c, child) for (node, c), child in steps.items())
        self.keys, self.child = np.array([k for k, _ in keys], np.int64), np.array([c for _, c in keys], np.int32)
        self.piece_at, self.score_at = np.full(len(steps) + 1, -1, np.int32), np.full(len(steps) + 1, -inf)
        scores = dict(self.pieces.values())
        for node, i in at_node.items():
            self.piece_at[node], self.score_at[node] = i, scores[i]
        self.surfaces = np.frombuffer(b"".join(self.surface), np.uint8)
        self.surface_size = np.fromiter(map(len, self.surface), np.int64, len(self.surface))
        self.surface_at = np.cumsum(self.surface_size) - self.surface_size
        self.single = np.zeros(0x110000, bool)  # characters that are pieces
        self.single[[ord(p) for p, _ in pieces if len(p) == 1]] = True

    def together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``forward`` and the best path of many words at once, all of whose characters are pieces: log-probabilities, leads, ids in one array, and where each word's end."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        rows, most = len(words), int(sizes.max())
        chars = np.zeros((most, rows), np.int64)
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        first = np.cumsum(sizes) - sizes
        chars[np.arange(len(flat)) - np.repeat(first, sizes), np.repeat(np.arange(rows), sizes)] = flat
        top, second = np.full((most + 1, rows), -inf), np.full((most + 1, rows), -inf)
        start, piece = np.zeros((most + 1, rows), np.int32), np.zeros((most + 1, rows), np.int32)
        top[0] = 0.0
        for i in range(most):
            who = np.flatnonzero(sizes > i)
            node = np.zeros(len(who), np.int64)
            for j in range(i + 1, min(i + self.longest, most) + 1):
                key = node << 21 | chars[j - 1, who]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                on = (self.keys[at] == key) & (sizes[who] >= j)
                who, node = who[on], self.child[at[on]].astype(np.int64)
                if not len(who):
                    break
                some = self.piece_at[node] >= 0
                w, s = who[some], top[i, who[some]] + self.score_at[node[some]]
                better = s >= top[j, w]  # of equal paths the one whose last arc is shortest
                up, down = w[better], w[~better]
                second[j, up] = top[j, up]
                second[j, down] = np.maximum(second[j, down], s[~better])
                top[j, up], start[j, up], piece[j, up] = s[better], i, self.piece_at[node[some][better]]
        score, lead = top[sizes, np.arange(rows)], np.full(rows, inf)
        place, who, order, found = sizes.copy(), np.arange(rows), [], []
        while len(who):
            at = place[who]
            lead[who] = np.minimum(lead[who], top[at, who] - second[at, who])
            order.append(who)
            found.append(piece[at, who])
            place[who] = start[at, who]
            who = who[place[who] > 0]
        order, ids = np.concatenate(order)[::-1], np.concatenate(found)[::-1]
        return score, lead, ids[np.argsort(order, kind="stable")], np.cumsum(np.bincount(order, minlength=rows))

    def arcs(self, word: str, j: int) -> Iterator[tuple[int, int, float]]:
        """The arcs that end at place ``j``: start, piece id (-1: the character in bytes) and log-probability."""
        get = self.endings.get
        if word[j - 1] not in self.pieces:
            yield j - 1, -1, self.byte_score * len(word[j - 1].encode("utf-8", "surrogatepass"))
        for i in range(j - 1, max(-1, j - self.longest - 1), -1):
            found = get(word[i:j])
            if found:
                yield i, *found
            elif found is None:
                break

    def forward(self, word: str, top: list[float], back: list[int], lead: list[float], same: int = 0) -> None:
        """Viterbi: log-probability of the best path to each place, where its last arc starts, and how much less likely the best path by another arc is; the first ``same`` places are known."""
        get, longest, scores = self.endings.get, self.longest, self.byte_score
        del top[same + 1 :], back[same + 1 :], lead[same + 1 :]
        for j in range(same + 1, len(word) + 1):
            start, next_ = j - 1, -inf
            char = word[start]
            found = get(char)
            best = top[start] + (found[1] if found else scores * len(char.encode("utf-8", "surrogatepass")))
            if found is not None:
                for i in range(j - 2, j - longest - 1 if j > longest else -1, -1):
                    found = get(word[i:j])
                    if found:
                        s = top[i] + found[1]
                        if s > best:
                            best, next_, start = s, best, i
                        elif s > next_:
                            next_ = s
                    elif found is None:
                        break
            top.append(best)
            back.append(start)
            lead.append(best - next_)

    def search(self, word: str, top: list[float], back: list[int], n: int) -> Iterator[tuple[float, bytes]]:
        """The ``n`` best segmentations, best first: how much less likely they are than the best, and ids.

        A-star from the end. The forward scores are exact, so that a path is finished at no further loss by the best
        arcs, and only the ``n`` least losses need to be kept open. An open path is its loss, the place it has come to,
        the arc that took it there, and what lies behind: so many pieces of another path.
        """
        heap: list[tuple] = [(0.0, 0, len(word), b"", [], 0, b"")]
        order = 0
        for room in range(n - 1, -1, -1):
            if not heap:
                return
            loss, _, place, arc, behind, size, tail = heap.pop(0)
            tail = arc + b"".join(behind[size - 1 :: -1] if size else []) + tail
            done: list[bytes] = []  # from the end
            while place:
                taken = b""
                for i, piece, s in self.arcs(word, place):
                    if i == back[place] and not taken:
                        taken = self.spelled(word, i, piece)
                        continue
                    worse = loss + (top[place] - (top[i] + s))
                    if len(heap) < room or room and worse < heap[-1][0]:
                        order += 1
                        insort(heap, (worse, order, i, self.spelled(word, i, piece), done, len(done), tail))
                        del heap[room:]
                done.append(taken)
                place = back[place]
            yield loss, b"".join(reversed(done)) + tail

    def spelled(self, word: str, place: int, piece: int) -> bytes:
        return self.ids_of[piece] if piece >= 0 else b"".join([self.ids_of[self.bytes[b]] for b in word[place].encode("utf-8", "surrogatepass")])

    def firsts(self, words: list[str]) -> Iterator[tuple[list[str], list[float], list[float], list[bytes], list[bool]]]:
        """Of each word: log-probability of the best segmentation, its lead over the second (infinite if there is none), its ids, and whether they decode to the word.

        The search's first path, and the least loss that it leaves open. Words of usual length are scored and
        decoded together, by numpy; of the others, what a word shares with the one before isn't scored again.
        """
        usual, others = [], []
        for word in sorted(words):
            (usual if len(word) <= TOGETHER else others).append(word)
        for a in range(0, len(usual), BATCH):
            part = usual[a : a + BATCH]
            sizes = np.fromiter(map(len, part), np.int64, len(part))
            codes = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32)
            odd = np.flatnonzero(np.add.reduceat(~self.single[codes], np.cumsum(sizes) - sizes)).tolist()
            if odd:
                others += [part[i] for i in odd]
                gone = set(odd)
                part = [w for i, w in enumerate(part) if i not in gone]
            if part:
                scores, leads, ids, stops = self.together(part)
                blob, ends = ids.astype(np.int32).tobytes(), (4 * stops).tolist()
                yield part, scores.tolist(), leads.tolist(), [blob[i:j] for i, j in zip([0, *ends], ends, strict=False)], self.spelled_together(ids, stops, part)
        get, ids_of = self.pieces.get, self.ids_of
        top, back, lead, last = [0.0], [0], [inf], ""
        for word in sorted(others):
            self.forward(word, top, back, lead, len(commonprefix((last, word))))
            last, place, least, ids = word, len(word), inf, []
            while place:
                start = back[place]
                piece = get(word[start:place])
                ids.append(ids_of[piece[0]] if piece else self.spelled(word, start, -1))
                if lead[place] < least:
                    least = lead[place]
                place = start
            ids.reverse()
            ids = b"".join(ids)
            yield [word], top[-1:], [least], [ids], [self.spells(ids, word)]

    def best(self, word: str, n: int) -> list[tuple[float, bytes]]:
        """The ``n`` best segmentations of a word, best first: loss of log-probability against the best, and ids."""
        top, back, lead = [0.0], [0], [inf]
        self.forward(word, top, back, lead)
        return list(self.search(word, top, back, n))

    def spelled_together(self, ids: np.ndarray, stops: np.ndarray, words: list[str]) -> list[bool]:
        """Whether each word's ids decode to it; all ids in one array, with where each word's end."""
        sizes = self.surface_size[ids]
        last = np.cumsum(sizes)
        got = self.surfaces[np.repeat(self.surface_at[ids] - (last - sizes), sizes) + np.arange(last[-1])]
        want = [w.encode("utf-8", "surrogatepass") for w in words]
        ends, want_ends = last[stops - 1], np.cumsum(np.fromiter(map(len, want), np.int64, len(want)))
        if len(got) != want_ends[-1] or (ends != want_ends).any():
            return [self.spells(i.tobytes(), w) for i, w in zip(np.split(ids, stops[:-1]), words, strict=True)]
        same = got == np.frombuffer(b"".join(want), np.uint8)
        return np.logical_and.reduceat(same, np.concatenate([[0], ends[:-1]])).tolist()

    def spells(self, ids: bytes, word: str) -> bool:
        """Whether ``ids`` decode to ``word``."""
        return b"".join(map(self.surface.__getitem__, memoryview(ids).cast("i"))) == word.encode("utf-8", "surrogatepass")

    def decode(self, ids) -> str:
        """The text that ``ids`` spell; broken bytes become replacement characters."""
        return b"".join([self.surface[i] for i in ids]).decode("utf-8", "replace")[1:]


class Encoder(dict):
    """Remembers words' best segmentations: maps a word to its row in a few arrays."""

    def __init__(self, vocabulary: Vocabulary, n: int):
        super().__init__()
        self.vocabulary, self.n, self.find = vocabulary, n, re.compile(vocabulary.words, re.S).findall
        self.short = lru_cache(10_000)(self.best)
        self.blobs, self.chars, self.score, self.delta, self.size, self.exact = [], 0, np.zeros(1024), np.zeros(1024), np.zeros(1024, np.int64), np.zeros(1024, bool)

    def best(self, word: str) -> list[tuple[float, bytes, bool]]:
        return [(loss, ids, self.vocabulary.spells(ids, word)) for loss, ids in self.vocabulary.best(word, self.n)]

    def choices(self, word: str) -> list[tuple[float, bytes, bool]]:
        return self.short(word) if len(word) < LONG else self.best(word)

    def learn(self, words: set[str]) -> None:
        """Segment new words, and decode them."""
        row = len(self.blobs)
        grown = max(len(self.score), 2 * (row + len(words)))
        if grown > len(self.score):
            self.score, self.delta, self.size, self.exact = (np.concatenate([x, np.zeros(grown - len(x), x.dtype)]) for x in (self.score, self.delta, self.size, self.exact))
        for part, scores, leads, blobs, exact in self.vocabulary.firsts(list(words)):
            stop = row + len(part)
            self.score[row:stop], self.delta[row:stop], self.size[row:stop], self.exact[row:stop] = scores, leads, list(map(len, blobs)), exact
            self.blobs += blobs
            self.chars += sum(map(len, part))
            self.update(zip(part, range(row, stop), strict=True))
            row = stop

    def encode(self, texts: list[str]) -> Iterator[list[tuple[float, bytes, bool]]]:
        """Of each text, the N best segmentations, best first: score, ids, and whether they decode to the text.

        Words are decoded where they are segmented: a character never lies in two of them, so that the
        pieces of a text spell it where those of all its words spell these and the words make up the text.
        """
        if len(self.blobs) > REMEMBER or self.chars > REMEMBER_CHARS:
            self.clear()
            self.blobs, self.chars = [], 0
        split = [self.find(" " + t) if t else [] for t in texts]
        self.learn(set().union(*split) - self.keys())
        for text, words in zip(texts, split, strict=True):
            at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
            best = [(float(self.score[at].sum()), {})]
            change = self.delta[at]
            places = np.argpartition(change, self.n - 2)[: self.n - 1] if len(at) >= self.n > 1 else np.arange(len(at) if self.n > 1 else 0)
            for p in sorted(places.tolist()):
                choices = self.choices(words[p])
                merged = [(s - loss, {**c, p: (ids, ok)} if k else c) for s, c in best for k, (loss, ids, ok) in enumerate(choices)]
                best = heapq.nsmallest(self.n, merged, key=lambda x: -x[0])
            first = b"".join([self.blobs[i] for i in at.tolist()])
            stops = np.cumsum(self.size[at])
            wrong = np.flatnonzero(~self.exact[at]).tolist()
            whole = "".join(words)[1:] == text
            out = []
            for score, changed in best:
                parts, last = [], 0
                for p, (ids, _) in changed.items():  # words that don't take their first choice, in order
                    parts += [first[last : stops[p] - self.size[at[p]]], ids]
                    last = stops[p]
                out.append((score, b"".join([*parts, first[last:]]), whole and all(ok for _, ok in changed.values()) and all(p in changed for p in wrong)))
            yield out


def parts(texts) -> Iterator[list[str]]:
    """Texts of an Arrow column in order (null: empty), in lists of about ``PART`` characters."""
    some, size = [], 0
    for cell in texts:
        t = cell.as_py() or ""
        some.append(t)
        size += len(t)
        if size >= PART:
            yield some
            some, size = [], 0
    if some:
        yield some


def lists(blobs: list[bytes]) -> pa.ListArray:
    """Ids of each blob as a list."""
    ends = np.cumsum([0, *map(len, blobs)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(blobs), np.int32)))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, model_file: str | None = None, digest: bool = False) -> DataFrame:
    """N-best encodings, one row for each row of ``docs``.

    ``(id, ids, n_best)``: ids of the best segmentation, and an array of ``(score, ids)`` of the N best; with
    ``digest``, ``(id, n_pieces, n_best, best_score, margin, ids_sha256, exact, segmentations)`` instead: how many pieces, how many
    segmentations were found, the best one's log-probability, its lead over the second (null if there is
    none), the hash of its ids as text, whether decoding each of the N gives the text again, and an array of
    ``(score, ids, n_pieces, ids_sha256, exact)`` of the N best. Null and empty texts
    have no pieces and one empty segmentation of score 0. Repeated rows repeat; no rows give no rows.
    """
    vocabulary = Vocabulary(model_file or default_model())
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)  # the vocabulary's size is fixed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(shared.value, n)
        for batch in slices(batches):
            at = 0
            for part in parts(batch.column("text")):
                found = list(coder.encode(part))
                names = batch.column("id").slice(at, len(part))
                at += len(part)
                each = [x for best in found for x in best]
                ends = pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32))
                scores, ids = pa.array([s for s, _, _ in each], pa.float64()), lists([b for _, b, _ in each])
                if digest:
                    checks = [(len(b) // 4, hashlib.sha256(b).hexdigest(), ok) for _, b, ok in each]
                    columns = [pa.array(c, k) for c, k in zip(zip(*checks, strict=True), (pa.int64(), pa.string(), pa.bool_()), strict=True)]
                    every = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([scores, ids, *columns], ["score", "ids", "n_pieces", "ids_sha256", "exact"]))
                    out, k = [], 0
                    for best in found:
                        margin = best[0][0] - best[1][0] if len(best) > 1 else None
                        out.append((checks[k][0], len(best), best[0][0], margin, checks[k][1], all(c[2] for c in checks[k : k + len(best)])))
                        k += len(best)
                    kinds = (pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.string(), pa.bool_())
                    columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([names, *columns, every], ["id", "n_pieces", "n_best", "best_score", "margin", "ids_sha256", "exact", "segmentations"])
                else:
                    every = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([scores, ids], ["score", "ids"]))
                    yield pa.RecordBatch.from_arrays([names, lists([best[0][1] for best in found]), every], ["id", "ids", "n_best"])

    kind = dict(rows.dtypes)["id"]
    if digest:
        each = "struct<score:double,ids:array<int>,n_pieces:bigint,ids_sha256:string,exact:boolean>"
        return rows.mapInArrow(run, f"id {kind}, n_pieces long, n_best int, best_score double, margin double, ids_sha256 string, exact boolean, segmentations array<{each}>")
    return rows.mapInArrow(run, f"id {kind}, ids array<int>, n_best array<struct<score:double,ids:array<int>>>")


def decode(encoded: DataFrame, ids_col: str = "ids", model_file: str | None = None) -> DataFrame:
    """``encoded`` with ``text``, which its ids spell; null ids give a null text."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(model_file or default_model()))

    @F.pandas_udf("string")
    def spell(ids):
        return ids.map(lambda x: None if x is None else shared.value.decode(list(x)))

    return encoded.withColumn("text", spell(ids_col))
