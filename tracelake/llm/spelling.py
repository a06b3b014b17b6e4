"""Grouping of spelling variants (operator 11).

Words that differ by one letter are found with a bidirectional index: a vocabulary, words set apart by a
delimiter, has a suffix array, of which only the letter before each suffix and counts of letters are kept
(an FM-index), and the reversed vocabulary has one too. An interval of suffix ranks stands for all places
of a pattern; it is extended by a letter on either side, and both indexes' intervals move together. One
search scheme matches the first half of a word exactly and extends to the right, one matches the second
half and extends to the left; each allows one error on its way. A pattern that has come to both delimiters
is a word, and the rank of its suffix is the word's number. All words are searched together, as arrays.

Words that one scheme can find have their first letters in common, those of the other their last, so that
the vocabulary is dealt to tasks by those letters; a task's index holds a bounded number of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import materialize, small

#: A run of letters (fixed by the task).
RUN = r"[A-Za-zÀ-ÿ]+"
DROP = 31  # of runs whose checksum this divides, one letter is dropped
LEAST = 7  # code points of a word
TIMES = 10  # how much more often a form must occur than the word
SHARED = 3  # letters at either end by which words are dealt to tasks: half of the shortest word, rounded down
LETTERS = 1 << 18  # letters that a task indexes, about
TILE = 1 << 22  # letters of a hot shard that a task indexes, or searches, together
ROUND = 8_192  # words that are searched together
STEP = 64  # bits of a word of the letters' bitmaps


def suffixes(codes: np.ndarray) -> np.ndarray:
    """Suffix array by doubling: suffixes are ranked by 1, 2, 4, ... letters until all ranks differ."""
    n = len(codes)
    rank, k = np.unique(codes, return_inverse=True)[1].astype(np.int64), 1
    while True:
        after = np.concatenate([rank[k:] + 1, np.zeros(min(k, n), np.int64)])
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        steps = np.diff(key[order]) > 0
        rank[order] = np.concatenate([[0], np.cumsum(steps)])
        if n < 2 or steps.all():
            return order
        k *= 2


class Index:
    """FM-index of a text of letters 0, 1, ...: for each letter where its suffixes begin, and how often it stands before the first ``i`` suffixes."""

    def __init__(self, codes: np.ndarray, letters: int):
        before = codes[suffixes(codes) - 1]  # of the first suffix, the last letter
        self.first = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=letters))]).astype(np.int64)
        n = len(codes) // STEP + 1
        self.bits, self.count = np.zeros((n, letters), np.uint64), np.zeros((n, letters), np.int64)
        place = np.arange(len(codes))
        np.bitwise_or.at(self.bits, (place // STEP, before), np.uint64(1) << (place % STEP).astype(np.uint64))
        self.count[1:] = np.cumsum(np.bitwise_count(self.bits), axis=0)[:-1]

    def rank(self, letter: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each letter stands before the first ``i`` suffixes."""
        block, low = i // STEP, (np.uint64(1) << (i % STEP).astype(np.uint64)) - np.uint64(1)
        return self.count[block, letter] + np.bitwise_count(self.bits[block, letter] & low)

    def ranks(self, i: np.ndarray) -> np.ndarray:
        """The same for all letters: a row for each ``i``."""
        block, low = i // STEP, (np.uint64(1) << (i % STEP).astype(np.uint64)) - np.uint64(1)
        return self.count[block] + np.bitwise_count(self.bits[block] & low[:, None])


class Vocabulary:
    """Distinct words in code-point order, and the index on which patterns grow to the side that a scheme takes.

    ``right``: patterns grow to the right, on the index of the reversed text, and the suffix ranks of the text itself
    are carried along. Else they grow to the left, on the text's index, whose own ranks name the words.
    """

    def __init__(self, words: list[str], right: bool):
        self.words, self.right = words, right
        flat = np.frombuffer("\n".join(["", *words, ""]).encode("utf-32-le"), np.uint32)
        self.alphabet, codes = np.unique(flat, return_inverse=True)  # the delimiter sorts first: letter 0
        self.index = Index(codes[::-1].copy() if right else codes, len(self.alphabet))

    def grown(self, low: np.ndarray, high: np.ndarray, carried: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals after a letter more. ``carried`` is where the other index's interval begins: smaller letters come before it there."""
        index = self.index
        new = index.first[letter] + index.rank(letter, low), index.first[letter] + index.rank(letter, high)
        if not self.right:  # the text's own ranks are at hand
            return *new, carried
        smaller = np.arange(len(self.alphabet)) < letter[:, None]
        return *new, carried + ((index.ranks(high) - index.ranks(low)) * smaller).sum(1)


def search(v: Vocabulary, words: list[str], within: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``(number in words, number in the vocabulary)`` of words one error apart whose first (``right``) or last half is the same.

    Of a word of L letters, the half holds L // 2 of them from the left, or the others from the right. ``within``: the
    vocabulary holds the words, so that a pattern that only one place matches has found its own word.
    """
    alone = int(within)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    known = np.searchsorted(v.alphabet, flat)
    codes = np.where(v.alphabet[np.minimum(known, len(v.alphabet) - 1)] == flat, known, len(v.alphabet))  # letters that the vocabulary lacks
    length = np.array([len(w) for w in words], np.int64)
    start = np.cumsum(length) - length
    half = length // 2 if v.right else length - length // 2
    strange = len(v.alphabet)

    def letter(word: np.ndarray, step: np.ndarray) -> np.ndarray:
        at = start[word] + (step if v.right else length[word] - 1 - step)
        inside = (step >= 0) & (step < length[word])
        return np.where(inside, codes[np.where(inside, at, 0)], 0)

    n = np.arange(len(words))
    delimiters = len(v.words) + 1  # their suffixes come first, that of the last delimiter before all
    # a pattern: its word, how many letters of it are behind, its interval, the other index's, and whether the error is made
    state = (n, np.zeros(len(n), np.int64), np.zeros(len(n), np.int64), np.full(len(n), delimiters), np.zeros(len(n), np.int64), np.zeros(len(n), bool))
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def take(s: tuple, keep: np.ndarray) -> tuple:
        return tuple(x[keep] for x in s)

    def grow(s: tuple, by: np.ndarray) -> tuple:
        """States after a letter; those that match nothing fall away."""
        word, step, low, high, carried, wrong = take(s, by < strange)
        low, high, carried = v.grown(low, high, carried, by[by < strange])
        return take((word, step, low, high, carried, wrong), high > low)

    while len(state[0]):
        word, step, low, high, carried, wrong = state
        following = []
        # patterns with their error, and those before their half's end, take the word's own letter
        own = letter(word, step)
        done = step == length[word]
        ended = take(state, done & wrong)
        if len(ended[0]):
            w, _, low_, _, carried_, _ = grow(ended, np.zeros(len(ended[0]), np.int64))
            found.append((w, (carried_ if v.right else low_) - 1))
        on = ~done & (wrong | (high - low > alone))
        go = take(state, on)
        following.append(grow((go[0], go[1] + 1, *go[2:]), own[on]))
        # patterns without error may err from the half's end on, where others share what is behind
        may = take(state, ~wrong & (step >= half[word]) & (high - low > alone))
        if len(may[0]):
            word, step, low, high, carried, _ = may
            own, left = letter(word, step), step < length[word]
            yes = np.ones(len(word), bool)
            following.append((word[left], step[left] + 1, low[left], high[left], carried[left], yes[left]))  # the other lacks the letter
            sizes = v.index.ranks(high) - v.index.ranks(low)
            which, other = np.nonzero(sizes[:, 1:])
            other += 1
            new = other != own[which]
            which, other = which[new], other[new]
            more = grow((word[which], step[which], low[which], high[which], carried[which], yes[which]), other)  # the other has one more
            following.append(more)
            same = more[1] < length[more[0]]
            following.append((more[0][same], more[1][same] + 1, *(x[same] for x in more[2:])))  # the other has another letter
        state = tuple(np.concatenate(x) for x in zip(*following, strict=True))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    pairs = np.unique(np.stack([a, b], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def neighbours(vocabulary: list[str], words: list[str], right: bool, within: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs ``(number in words, number in the vocabulary)`` that a scheme alone finds: those to the left leave out what the other finds too."""
    v = Vocabulary(vocabulary, right)
    for at in range(0, len(words), ROUND):
        a, b = search(v, words[at : at + ROUND], within)
        a = a + at
        if not right:
            own = np.array([words[i][: len(words[i]) // 2] != vocabulary[j][: len(words[i]) // 2] for i, j in zip(a.tolist(), b.tolist(), strict=True)], bool)
            a, b = a[own], b[own]
        yield a, b


def near_words(words: DataFrame, pairs: bool = False) -> DataFrame:
    """Of distinct ``words(word, n)`` of ``LEAST`` letters or more, those that differ by one letter more, less or other.

    ``word, n_near, form_n, form``, a row for each word that has near ones, form being the near one of largest
    n (of ties the first in code-point order); with ``pairs``, ``word, near``, a row for each two.
    Words are dealt to shards by their first and by their last letters; a shard of more than ``TILE`` letters is split
    into tiles, each of which indexes one part and searches the words of one part.
    """
    words = words.select("word", "n", F.length("word").alias("size"))
    every = F.array(F.struct(F.lit(True).alias("right"), F.substring("word", 1, SHARED).alias("key")), F.struct(F.lit(False).alias("right"), F.expr(f"right(word, {SHARED})").alias("key")))
    shards = max(1, -(-(words.agg(F.sum(F.col("size") + 1)).first()[0] or 0) // LETTERS))
    dealt = words.select("*", F.inline(every)).withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
    parts = dealt.groupBy("right", "shard").agg(F.ceil(F.sum(F.col("size") + 1) / TILE).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("word", F.lit(1)), "parts").cast("int")
    dealt = dealt.join(F.broadcast(parts), ["right", "shard"]).withColumn("part", part)  # a row a shard: letters / LETTERS at most, twice
    places = F.sequence(F.lit(0), F.col("parts") - 1)
    indexed = F.transform(places, lambda j: F.struct(F.col("part").alias("i"), j.alias("j")))
    searched = F.transform(places, lambda i: F.struct(i.alias("i"), F.col("part").alias("j")))
    tiles = dealt.select("right", "shard", "word", "n", "part", F.inline(F.array_union(indexed, searched)))
    names, kinds = (["word", "near"], [pa.string()] * 2) if pairs else (["word", "n_near", "form_n", "form"], [pa.string(), pa.int64(), pa.int64(), pa.string()])
    shape = pa.schema(list(zip(names, kinds, strict=True)))

    def run(key: tuple, tile: pa.Table) -> pa.Table:
        right, _, i, j = (k.as_py() for k in key)
        index = tile.filter(pc.equal(tile["part"], i)).sort_by("word")
        vocabulary, n = index["word"].to_pylist(), index["n"].to_numpy()
        own = tile.filter(pc.equal(tile["part"], j))["word"].to_pylist()
        out = [[], [], [], []]
        for a, b in neighbours(vocabulary, own, right, i == j):
            if not pairs:  # the best of each word, and how many there are
                a, b = (x[np.lexsort((b, -n[b], a))] for x in (a, b))
                first = np.flatnonzero(np.diff(a, prepend=-1))
                out[1] += np.diff(first, append=len(a)).tolist()
                out[2] += n[b[first]].tolist()
                a, b = a[first], b[first]
            out[0] += [own[k] for k in a]
            out[3] += [vocabulary[k] for k in b]
        return pa.table([out[0], out[3]] if pairs else out, schema=shape)

    key = ["right", "shard", "i", "j"]  # a task for each two shards of either side: few bytes, but much work
    found = tiles.repartition(min(10_000, 2 * shards), *key).groupBy(*key).applyInArrow(run, "word string, near string" if pairs else "word string, n_near long, form_n long, form string")
    if pairs:
        return found
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form")


def lower(c: Column) -> Column:
    """``c`` with A-Z alone in lower case."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: what runs of letters become, of ``LEAST`` letters or more, that occur twice or more.

    A run whose checksum with its document's id is a multiple of ``DROP`` loses a letter. Null texts have no runs; a null
    id counts as an empty one; repeated rows count each time; other columns play no part.
    """
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= LEAST).select("id", lower(F.col("run")).alias("run")).select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = F.col("h") % F.length("run")
    less = F.concat(F.substr("run", F.lit(1), at.cast("int")), F.substr("run", (at + 2).cast("int")))
    word = F.when(F.col("h") % DROP == 0, less).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= LEAST).groupBy("word").agg(F.count("*").alias("n")).where("n >= 2")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``forms(word, form)``: the last form that following forms leads to. Each pass follows twice as many."""
    found = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = materialize(found.join(small(ahead), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        found = further.drop("moved")
        if further.where("moved").isEmpty():
            return found


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words of all texts with the form each is a variant of: ``word, form, root, n, n_near, form_n``.

    A word's form is its near word of largest n (ties: first in code-point order) where that is ``TIMES`` times its
    own; root is the last form that following forms leads to, or the word itself. No texts give no rows.
    """
    words = materialize(counted_words(docs, id_col, text_col))
    near = words.join(near_words(words), "word", "left")
    near = materialize(near.withColumn("is", F.coalesce(F.col("form_n") >= TIMES * F.col("n"), F.lit(False))))
    formed = near.where("is")
    root = small(roots(formed))
    pick = lambda c: F.when(F.col("is"), F.col(c)).alias(c)
    return near.join(root, "word", "left").select("word", pick("form"), F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), pick("form_n"))
