"""Variants of words: the index against plain comparison, and whole results against a plain version."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tracelake.llm import spelling
from tracelake.llm.queries import QUERIES


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def some_words(seed, n=250, letters="abé"):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(7, 11))) for _ in range(n)})


def test_suffixes_and_ranks():
    text = "\nabab\nabba\nb\nbaab\n"
    codes = np.unique(list(text), return_inverse=True)[1]
    order = spelling.suffixes(codes)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    index = spelling.Index(codes, 3)
    before = [codes[i - 1] for i in order]
    for i in range(len(text) + 1):
        assert index.ranks(np.array([i]))[0].tolist() == [before[:i].count(c) for c in range(3)]
        assert index.rank(np.array([1]), np.array([i]))[0] == before[:i].count(1)


@pytest.mark.parametrize("letters", ["ab", "abé", "abcdefgh"])
@pytest.mark.parametrize("within", [True, False])
def test_schemes_find_all_words_one_error_apart(letters, within):
    words = some_words(1, letters=letters) + ["a" * 40, "a" * 41, "b" + "a" * 40]
    words = sorted(set(words))
    asked = words if within else sorted({*some_words(2, letters=letters), *words[::3], "zzzzzzz", "abababaz", "zabababa"})
    found = []
    for right in (True, False):
        for a, b in spelling.neighbours(words, asked, right, within):
            found += [(asked[i], words[j]) for i, j in zip(a, b, strict=True)]
    assert len(found) == len(set(found))
    assert set(found) == {(a, b) for a in asked for b in words if one_apart(a, b)}


@pytest.mark.parametrize("tile", [spelling.TILE, 200])
def test_tiles_find_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(spelling, "TILE", tile)
    monkeypatch.setattr(spelling, "LETTERS", 2000)
    words = some_words(3, 400)
    frame = spark.createDataFrame([(w, k % 7 + 1) for k, w in enumerate(words)], "word string, n long")
    near = {w: [x for x in words if one_apart(w, x)] for w in words}
    pairs = [(r.word, r.near) for r in spelling.near_words(frame, pairs=True).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {(w, x) for w, some in near.items() for x in some}
    n = {w: k % 7 + 1 for k, w in enumerate(words)}
    for r in spelling.near_words(frame).collect():
        best = min(near[r.word], key=lambda x: (-n[x], x))
        assert (r.n_near, r.form_n, r.form) == (len(near[r.word]), n[best], best)


def brute(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x7f" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += len(run) >= 7
    n = {w: k for w, k in n.items() if k >= 2}
    near = {w: [x for x in n if one_apart(w, x)] for w in n}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


def tuples(frame):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()), key=str)


def test_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    words = ["Kilometer", "Überraschung", "überraschung", "straßenbahn", "ÀÉÎõü÷×ÿ", "generation", "generatione", "generations", "short", "embeddings", "x" * 3000]
    texts = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(60)]
    texts += [" ".join(["variants"] * 220 + ["variantz"] * 22 + ["bariantz"] * 2 + ["uariants", "uariants", "variant"])] + [None, "", "1 2 ,;", "a日bcdefgh日 abcdefgh abcdefgh"]
    rows = [(k if k % 13 else None, t, "w") for k, t in enumerate(texts)] + [(5, texts[5], "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string").repartition(5)
    want = sorted(brute([r[:2] for r in rows]), key=str)
    assert tuples(spelling.variants(docs)) == want
    assert ("bariantz", "variantz", "variants") in [w[:3] for w in want]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert tuples(QUERIES["op11_spelling_variants"](spark, str(tmp_path))) == want


def test_no_texts(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
