"""Directly addressable codes: files against the library's own encoding of whole texts."""

import os
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tracelake.llm import codes
from tracelake.llm.queries import QUERIES
from tracelake.llm.words import LowerWords, Remembered, blobs, library, vocabulary

TEXTS = [
    None, "", " ", "Hello wor", "  a  b\n\nc\td\r\n", "ünïcode é É Σς ΟΔΟΣ", "it's they'll I'M", "\U0001f600 q　w e\x85r\x1cs\x1ft",
    "<|startoftext|> and x<|endoftext|>y", "a\x00b", "12 345", "x" * 5000, "word " * 3000, "é" * 700, "ab" * 40_000,
]


def whole(texts):
    tokenizer = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


def test_words_give_the_ids_of_whole_texts(monkeypatch):
    rng = random.Random(3)
    letters = "ab'sSé́ \n\t　\x1cΣ1<|endoftext|>.,;!-ÀÿßJ̌×"
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice(letters) for _ in range(60)) for _ in range(300)]
    memory, encoder = Remembered(kept=1000), LowerWords(vocabulary("word_bpe_49k.json"))
    got = [np.frombuffer(b, "<u4").tolist() for k in range(0, len(texts), 40) for b in codes.encoded(texts[k : k + 40], memory, encoder, 2)]
    assert got == whole(texts)


def test_words_of_letters_are_those_of_the_library():
    words = ["Straße", "ÀÉÎ...", "word", "word.", "WORD!?", "it's", "a1", "x×y", "don't.", "naïve--", "", ".", "...", "µm", "ªa", "<|endoftext|>", "a<|endoftext|>", "ŁÓDŹ", "ǰ", "é́."]
    path = vocabulary("word_bpe_49k.json")
    encoder = LowerWords(path)
    assert encoder.simple and encoder(words) == blobs(library(path)(words))


@pytest.mark.parametrize("values", [[0], [], [5, 49407, 2, 2, 0], list(range(3000)), [2**31, 1, 2**32 - 1], [1] * 1500 + [70000] * 600])
def test_any_run_is_read_without_the_rest(values):
    ids = np.array(values, "<u4")
    lengths = [len(values) // 2, len(values) - len(values) // 2]
    data = codes.coded([7, None], lengths, ids)
    read = []

    def part(size, place):
        read.append(size)
        return data[place : place + size]

    file = codes.Codes(part)
    assert file.tokens(0, len(values)).tolist() == values
    for i in range(0, len(values), 97):
        read.clear()
        assert file.tokens(i, i + 1).tolist() == [values[i]]
        assert sum(read) <= len(file.levels) * (codes.BLOCK // 8 + 16)
    doc_ids, known, ends = file.documents()
    assert doc_ids[known].tolist() == [7] and ends.tolist() == [lengths[0], len(values)]


def test_widths_are_the_smallest():
    rng = np.random.default_rng(4)
    ids = np.minimum(rng.zipf(1.3, 4000), 49_407).astype(np.uint32)

    def cost(sizes):
        total, rest = 0, ids
        for k, w in enumerate(sizes):
            total += len(rest) * (w + (k + 1 < len(sizes)))
            rest = rest[(rest >> w) > 0] >> w
        return total

    def splits(n):
        yield [n]
        for k in range(1, n):
            yield from ([k, *rest] for rest in splits(n - k))

    assert cost(codes.widths(ids)) == min(map(cost, splits(int(ids.max()).bit_length())))


@pytest.mark.parametrize("file_tokens", [codes.FILE_TOKENS, 50])
def test_files_hold_all_documents(spark, monkeypatch, file_tokens):
    monkeypatch.setattr(codes, "FILE_TOKENS", file_tokens)
    rows = [(3 * k if k != 4 else None, t, "x") for k, t in enumerate(TEXTS)] + [(30, "of the same id", "x"), (30, "of the same id", "x")]
    random.Random(5).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(5)
    folder, contents = codes.write_codes(docs)
    got = sorted(codes.read_codes(folder, contents).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows if r[0] is not None)) + [None]
    ids_of = {}
    for (i, t, _), ids in zip(rows, whole([r[1] for r in rows]), strict=True):
        ids_of.setdefault(i, []).append(ids)
    at = 0
    for r in got:
        assert list(r.ids) in ids_of[r.doc_id]
        ids_of[r.doc_id].remove(list(r.ids))
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        at += r.n_tokens
    every = [t for r in got for t in r.ids]
    asked = [0, 1, len(every) - 1, len(every), 100, 100, None]
    found = codes.tokens_at(folder, contents, spark.createDataFrame([(x,) for x in asked], "position long")).collect()
    assert sorted((r.position, r.token) for r in found) == sorted((p, every[p]) for p in asked if p is not None and p < len(every))


def test_no_documents(spark):
    folder, contents = codes.write_codes(spark.createDataFrame([], "doc_id long, text string"))
    assert contents.count() == 0 and codes.read_codes(folder, contents).count() == 0


def test_query(spark, tmp_path):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    at = 0
    for r, ids in zip(sorted(QUERIES["op13_token_codes"](spark, str(tmp_path)).collect()), whole(TEXTS), strict=True):
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_the_library_starts_no_threads():
    """Workers have a core each. In a process of its own, since threads stay."""
    import subprocess
    import sys

    code = "\n".join([
        "import os", "from tracelake.llm import words", "path = words.vocabulary('word_bpe_49k.json')", "encode, whole = words.LowerWords(path), words.library(path)",
        "before = len(os.listdir('/proc/self/task'))", "some = [f'{a}{b}{c}' for a in 'abcdefghij' for b in 'klmnopqrst' for c in 'uvwxyzabcd']", "encode(some), whole(some)",
        "print(len(os.listdir('/proc/self/task')) - before)",
    ])
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"} | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))}
    assert subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, check=True).stdout.strip() == "0"
