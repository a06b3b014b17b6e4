"""Tokenizers of the public vocabulary files, with the ids of words kept from one text to the next.

A text is cut where no token of the tokenizer can reach across, so that encoding the parts gives the ids
of the whole text; each distinct part is then encoded once by the library. What is kept is bounded in
size and dropped when the bound is reached. Ids are bytes of little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import ctypes
import json
import os
import re
from collections.abc import Callable
from itertools import chain

import numpy as np

KEPT = 3 << 21  # characters of words whose ids a worker keeps, about; as many again are older
TOGETHER = 100  # words that are handed to the library as one text
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
MARKS = '!"#$%&()*+,-./:;=?@[]^_`{}~'  # marks that may close a word; none takes part in a contraction or a special token


def vocabulary(name: str) -> str:
    """Place of one of the public vocabulary files."""
    import public_tokenizers

    return public_tokenizers.path(name)


def alone() -> None:
    """Have the tokenizers library work in its caller's thread: a task has one core, and threads of its own for each worker only wait for one another and keep memory."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def library(path: str, plain: bool = False) -> Callable[[list[str]], list[list[int]]]:
    """Encoder of many texts by the tokenizers library; ``plain``: strings of special tokens are text."""
    from tokenizers import Tokenizer

    alone()
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = plain
    return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def release() -> None:
    """Hand freed memory back to the system, where its C library can: Python workers outlive their tasks, and what libraries have freed would add up."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def blobs(lists: list[list[int]]) -> list[bytes]:
    """Ids of each list as bytes."""
    raw, ends = np.fromiter(chain.from_iterable(lists), "<u4").tobytes(), (4 * np.cumsum([0, *map(len, lists)])).tolist()
    return [raw[i:j] for i, j in zip(ends, ends[1:])]  # noqa: B905


class Remembered:
    """Ids of words; ``learn`` is given the function that encodes many, so that nothing here refers back to its owner and memory is free as soon as a task ends.

    Two generations are kept: when the younger is full, the older goes, but for words that have been met since.
    """

    def __init__(self, kept: int = KEPT):
        self.kept, self.size, self.known, self.older = kept, 0, {}, {}

    def learn(self, texts: list[list[str]], encode: Callable[[list[str]], list[bytes]]) -> dict[str, bytes]:
        """Ids of at least these texts' words."""
        if self.size > self.kept:
            self.known, self.older, self.size = {}, self.known, 0
        new = list(set().union(*texts).difference(self.known))
        again = [w for w in new if w in self.older] if self.older else []
        self.known.update((w, self.older[w]) for w in again)
        unknown = [w for w in new if w not in self.known] if again else new
        if unknown:
            self.known.update(zip(unknown, encode(unknown), strict=True))
        self.size += sum(map(len, new)) + 16 * len(new)
        return self.known


class LowerWords:
    """Words of a tokenizer that takes them in lower case, as runs of letters and of marks, each ending in a piece with the word's end.

    A word of letters alone needs none of that preparation: such words are handed over many at a time, and the pieces
    with a word's end tell them apart. Marks that close such a word are a run of their own. All other words, and all words
    of a tokenizer of another make, are encoded as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole, bare = library(path), Tokenizer.from_file(path)
        made = lambda part: json.loads(part.__getstate__()) if part is not None else {}
        first, then = made(bare.normalizer), made(bare.pre_tokenizer)
        suffix = getattr(bare.model, "end_of_word_suffix", None)
        self.simple = bool(suffix) and [x["type"] for x in first.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in then.get("pretokenizers", [])] == ["Split", "ByteLevel"] and r"|[\p{L}]+|" in then["pretokenizers"][0]["pattern"].get("Regex", "")
        bare.normalizer, bare.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.bare = bare
        self.closing = np.zeros(bare.get_vocab_size(), bool)
        if self.simple:
            self.closing[[i for piece, i in bare.get_vocab().items() if piece.endswith(suffix)]] = True
        self.cores, self.tails = Remembered(), Remembered()

    def letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of lower-case letters."""
        groups = [words[at : at + TOGETHER] for at in range(0, len(words), TOGETHER)]
        out = []
        for group, encoding in zip(groups, self.bare.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(encoding.ids, "<u4")
            raw, ends = ids.tobytes(), (4 * np.flatnonzero(self.closing[ids]) + 4).tolist()
            out += [raw[i:j] for i, j in zip([0, *ends], ends, strict=False)]
            if len(ends) != len(group):
                raise ValueError("words and their ends differ in number")
        return out

    def __call__(self, words: list[str]) -> list[bytes]:
        if not self.simple:
            return blobs(self.whole(words))
        cores = [w.rstrip(MARKS) for w in words]
        plain = [c.lower() if LETTERS.fullmatch(c) else None for c in cores]
        tails = [w[len(c) :] if p else w for w, c, p in zip(words, cores, plain, strict=True)]
        known, ends = self.cores.learn([[p for p in plain if p]], self.letters), self.tails.learn([tails], lambda words: blobs(self.whole(words)))
        return [known[p] + ends[t] if p else ends[t] for p, t in zip(plain, tails, strict=True)]
