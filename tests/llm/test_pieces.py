"""All N segmentations are spelled, by the registered query and the pipeline's stage."""

import base64
import hashlib
import os
import random
import re
import subprocess
import sys
import tracemalloc

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_texts import every_segmentation
from tracelake.llm import pieces
from tracelake.llm.queries import QUERIES

TEXTS = [None, "", "Hello wor", "  a  b", "ünïcode", "aaaaaaaa", "\U0001f600 q", "a\U0001f600b", "word " * 300]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("texts"))
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    return folder


def test_query_spells_every_segmentation(spark, folder):
    v = pieces.Vocabulary(pieces.default_model())
    for r in QUERIES["op6_sentencepiece_n_best"](spark, folder).collect():
        text = TEXTS[r.doc_id] or ""
        assert r.exact and len(r.segmentations) == r.n_best and len({tuple(x.ids) for x in r.segmentations}) == r.n_best
        assert r.ids_sha256 == r.segmentations[0].ids_sha256 and r.best_score == r.segmentations[0].score
        for x in r.segmentations:
            assert x.exact and v.decode(x.ids) == text and x.n_pieces == len(x.ids)
            assert x.ids_sha256 == hashlib.sha256(np.array(x.ids, "<i4").tobytes()).hexdigest()
        if text and len(text) < 12:
            every = every_segmentation(v, text)
            score_of = {tuple(ids): s for s, ids in every}
            assert [x.score for x in r.segmentations] == pytest.approx([s for s, _ in every[:4]])
            assert all(score_of[tuple(x.ids)] == pytest.approx(x.score) for x in r.segmentations)


def test_stage_keeps_every_segmentation(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    v = pieces.Vocabulary(pieces.default_model())
    for r in corpus_pipeline.encode_pieces(spark, docs, folder).collect():
        assert r.n_best[0].ids == r.ids and [x.score for x in r.n_best] == r.scores
        assert all(v.decode(x.ids) == (TEXTS[r.doc_id] or "") for x in r.n_best)


def test_long_run_without_spaces():
    v = pieces.Vocabulary(pieces.default_model())
    run = base64.b64encode(random.Random(4).randbytes(150_000)).decode()
    coder = pieces.Encoder(v, 4)
    tracemalloc.start()
    (best,) = coder.encode([run])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(run) == 200_000 and peak < 200e6  # the ids of all prefixes would be 60 GB
    assert len({ids for _, ids, _ in best}) == 4 and [s for s, _, _ in best] == sorted((s for s, _, _ in best), reverse=True)
    assert all(v.decode(np.frombuffer(ids, np.int32).tolist()) == run for _, ids, _ in best)


def test_remembered_words_are_bounded_in_characters(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBER_CHARS", 10_000)
    coder = pieces.Encoder(pieces.Vocabulary(pieces.default_model()), 4)
    for i in range(20):
        list(coder.encode([f"{i}" + "ab" * 2_000]))
    assert sum(map(len, coder)) < 20_000 and coder.short.cache_info().currsize < 20


def test_words_scored_together_as_one_by_one(monkeypatch):
    v = pieces.Vocabulary(pieces.default_model())
    r = random.Random(8)
    letters = ["a", "b", "e", "n", "ing", "tion", "é", "ß", "0", "1", "-", ".", "и", "中", "th", " the", "̀"]
    words = list({w for _ in range(2_000) for w in re.findall(v.words, "".join(r.choices(letters, k=r.randint(1, 12))))})
    together = {w: x for part in v.firsts(words) for w, *x in zip(*part, strict=True)}
    monkeypatch.setattr(pieces, "TOGETHER", 0)
    apart = {w: x for part in v.firsts(words) for w, *x in zip(*part, strict=True)}
    assert together == apart and set(apart) == set(words) and all(x[3] for x in apart.values())


def paths(v, word, n):
    """The n best segmentations by plain dynamic programming over lists of the n best prefixes."""
    best = [[(0.0, ())], *([] for _ in word)]
    for j in range(1, len(word) + 1):
        some = [(s + score, (*ids, i if i >= 0 else word[a])) for a, i, score in v.arcs(word, j) for s, ids in best[a]]
        best[j] = sorted(some, key=lambda x: -x[0])[:n]
    return best[-1]


def test_n_best_of_longer_texts_against_plain_dynamic_programming():
    v = pieces.Vocabulary(pieces.default_model())
    r = random.Random(9)
    letters = ["aa", "b", "e ", "n", "ing", "tion", "0", "1", " the", "ß"]
    for size in (20, 60, 150):
        for _ in range(8):
            text = "".join(r.choices(letters, k=size))
            (got,) = pieces.Encoder(v, 4).encode([text])
            assert [s for s, _, _ in got] == pytest.approx([s for s, _ in paths(v, " " + text, 4)])
            assert all(ok and v.decode(np.frombuffer(ids, np.int32).tolist()) == text for _, ids, ok in got)


def test_wrong_ids_are_told_from_right_ones(monkeypatch):
    v = pieces.Vocabulary(pieces.default_model())
    v.surfaces = v.surfaces.copy()
    v.surfaces[v.surface_at[v.pieces[" the"][0]]] ^= 1
    (got,) = pieces.Encoder(v, 2).encode(["see the end"])
    assert not got[0][2]
    assert v.spells(np.array([v.pieces[" the"][0]], np.int32).tobytes(), " the") and not v.spells(b"", " the")


MILLION = """
import base64, random, resource, numpy as np
from tracelake.llm import pieces
v = pieces.Vocabulary(pieces.default_model())
run = base64.b64encode(random.Random(5).randbytes(750_000)).decode()
(best,) = pieces.Encoder(v, 4).encode([run])
assert len({ids for _, ids, _ in best}) == 4 and all(ok for _, _, ok in best)
assert v.decode(np.frombuffer(best[0][1], np.int32).tolist()) == run and len(run) == 1_000_000
assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss < 1e6  # KB
"""


def test_million_characters_without_spaces():
    subprocess.run([sys.executable, "-c", MILLION], check=True, cwd=os.path.dirname(os.path.dirname(os.path.dirname(__file__))), timeout=300)
