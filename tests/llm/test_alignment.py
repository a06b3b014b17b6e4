"""Alignment of two tokenizers against whole encodings and plain sets of byte offsets."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tracelake.llm import alignment
from tracelake.llm.queries import QUERIES
from tracelake.llm.words import vocabulary

TEXTS = [
    None, "", " ", "\n", "Hello wor, tokenization!", "  a   b\n\n  c\td \n e\r\n f", "ünïcode é \U0001f600\U0001f601 日本語 q　w e\x85r\x1cs \x1ft",
    "<|endoftext|> <s>x</s> <unk> <0x41>", "a ▁ b", "a\x00b", "it's they'll I'M", "x" * 5000, "the cat sat on the mat. " * 400, "the cat sat on the mat. " * 3, "ab c" * 9000, "a" + " " * 3000 + "b",
]


def brute(texts):
    a = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    spelled = alignment.bytes_of_bytelevel(vocabulary("byte_bpe_50k.json")), alignment.bytes_of_pieces(b)
    out, held = [], Counter()
    for text in texts:
        ids = [], []
        if text:
            ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            if any(b"".join(s[i] for i in x) != (" " + text).encode() for s, x in zip(spelled, ids, strict=True)):
                ids = [], []
        ends = [np.cumsum([len(s[i]) for i in x]).tolist() for s, x in zip(spelled, ids, strict=True)]
        shared = sorted(set(ends[0]) & set(ends[1]))
        group_of = {e: k for k, e in enumerate(shared)}
        sides = []
        for x, own in zip(ids, ends, strict=True):
            some, k = defaultdict(list), 0
            for i, e in zip(x, own, strict=True):
                some[k].append(i)
                k += e in group_of
            sides.append(some)
        groups = [(sides[0][k], sides[1][k]) for k in range(len(shared))]
        pairs = Counter((x, y) for some, others in groups for x in some for y in others)
        held.update(pairs.keys())
        out.append((ids, groups, pairs))
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    rows = []
    for ids, groups, pairs in out:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(n for p, n in pairs.items() if held[p] == most[p[0]])
        rows.append((len(ids[0]), len(ids[1]), len(groups), sum(pairs.values()), best, sum(n * held[p] for p, n in pairs.items()), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return rows, out


def odd_texts():
    rng = random.Random(6)
    letters = ["a", "b", " ", " ", "  ", "\n", "\t", "é", "日", "▁", "'s", "\x1c", "1", "the ", "\r", "　", "\U0001f600"]
    return TEXTS + ["".join(rng.choice(letters) for _ in range(40)) for _ in range(300)]


def test_windows_give_the_groups_of_whole_texts(monkeypatch):
    monkeypatch.setattr(alignment, "KEPT", 500)
    texts = odd_texts()
    aligner = alignment.Aligner(vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    for k in range(0, len(texts), 30):
        for found, (ids, groups, _) in zip(aligner.align(texts[k : k + 30]), brute(texts[k : k + 30])[1], strict=True):
            a, b, numbers = found
            assert (list(a), list(b)) == tuple(map(list, ids))
            text = ";".join(aligner.windows.text[n] for n in numbers)
            assert text == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


def test_anchors_split_texts():
    aligner = alignment.Aligner(vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    ((a, b, numbers),) = aligner.align(["the cat sat on the mat " * 50 + "end"])
    assert len(numbers) == 301 and len(aligner.windows.known) < 10


@pytest.mark.parametrize("few", [alignment.FEW, 3])
def test_against_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(alignment, "SPELLED", few)
    texts = odd_texts()
    rows = [(k if k % 50 else None, t, "x") for k, t in enumerate(texts)] + [(7, texts[7], "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, a string").repartition(6)
    got = sorted((tuple(r) for r in alignment.agreement(docs, few=few).collect()), key=str)
    assert got == sorted(((i, *row) for (i, _, _), row in zip(rows, brute([r[1] for r in rows])[0], strict=True)), key=str)


def test_spans(spark):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "doc_id long, text string")
    for r, (ids, groups, pairs) in zip(sorted(alignment.aligned(docs).collect()), brute(TEXTS)[1], strict=True):
        assert (r.a_ids, r.b_ids) == tuple(map(list, ids))
        cuts = list(zip([0, *r.a_ends], r.a_ends, [0, *r.b_ends], r.b_ends, strict=False))
        assert [(r.a_ids[i:j], r.b_ids[m:n]) for i, j, m, n in cuts] == groups
        assert {(p.a, p.b): p.times for p in r.pairs} == dict(pairs)


def test_query_and_no_documents(spark, tmp_path):
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in QUERIES["op12_alignment"](spark, str(tmp_path)).collect())
    assert got == [(k, *row) for k, row in enumerate(brute(TEXTS)[0])]
    assert alignment.agreement(spark.createDataFrame([], "doc_id long, text string")).count() == 0
