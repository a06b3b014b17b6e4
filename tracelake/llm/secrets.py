"""Secret scans (operator 9): base rules, and character Markov models for what the rules miss.

Two first-order Markov models over characters, one of random strings and one of ordinary identifiers
and words, are trained from labelled samples; a long token outside the base spans is a secret where
the log-likelihood ratio between them is large enough (larger for tokens without digits, most of which
are words). Texts are read whole, in time linear in their length.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import slices

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")  # whole runs of 16 or more are what [0-9a-f]+ finds of that length
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SAMPLE_ROWS = 20_000  # documents, about as many, those of smallest hash, whose tokens are labelled samples
LEAST_GAIN = 12.0  # natural log; a random token is then 160,000 times likelier under the random model
LEAST_GAIN_LETTERS = 24.0  # the same for tokens without digits


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base rules, sorted."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


#: Code of each byte: its place in the alphabet, or the number of letters, which stands for a token's start.
CODES = bytes(ALPHABET.find(chr(b)) if chr(b) in ALPHABET else len(ALPHABET) for b in range(256))


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("ascii").translate(CODES), np.uint8).astype(np.int64)


class Markov:
    """Transition log-probabilities with a start state, add-one smoothed."""

    def __init__(self, counts: np.ndarray):
        self.log = np.log((counts + 1) / (counts + 1).sum(axis=1, keepdims=True))

    @staticmethod
    def counts(tokens: list[str]) -> np.ndarray:
        """How often a letter follows another, or a token's start: all tokens are counted together, each after a start mark."""
        n = len(ALPHABET)
        c = codes("\n".join(["", *tokens]))
        step = c[:-1] * n + c[1:]
        return np.bincount(step[c[1:] < n], minlength=(n + 1) * n).reshape(n + 1, n).astype(float)


def gain(token: str, noise: Markov, plain: Markov) -> float:
    """Log-likelihood of a token as a random string, less that as an ordinary one."""
    c = codes("\n" + token)
    return float((noise.log[c[:-1], c[1:]] - plain.log[c[:-1], c[1:]]).sum())


def random_strings(n: int = 4000) -> list[str]:
    """Labelled random strings of the usual key alphabets; the same on every run."""
    r, sets = random.Random(5), (ALPHABET[:62], ALPHABET[:64], ALPHABET[26:62], ALPHABET[:26] + ALPHABET[52:62], "0123456789abcdef")
    return ["".join(r.choices(sets[k % len(sets)], k=r.randint(16, 48))) for k in range(n)]


#: Parts that ordinary identifiers are made of (fixed values).
PARTS = "get set is has user name id list map file path data base table column index count total size time date start end first last next new old max min load save read write open close parse format string number value key type error message result request response server client config test main class object array item node tree request version release build input output image page link order price customer address email phone city state country street".split()


def identifiers(n: int = 4000) -> list[str]:
    """Labelled ordinary identifiers in the usual styles; the same on every run."""
    r, out = random.Random(6), []
    for k in range(n):
        words = r.choices(PARTS, k=r.randint(1, 4))
        style = k % 4
        name = "_".join(words) if style == 0 else "-".join(words) if style == 1 else words[0] + "".join(w.title() for w in words[1:]) if style == 2 else "_".join(words).upper()
        out.append(name + (str(r.randint(0, 2030)) if k % 5 == 0 else ""))
    return out


def train(docs: DataFrame) -> tuple[Markov, Markov]:
    """Models of random and of ordinary strings.

    Ordinary strings are generated identifiers and the words of a bounded sample of documents outside
    their base spans (but for long ones with digits, which nobody has labelled); random ones are generated
    keys and the values of base spans there.
    """

    def label(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        word = re.compile(r"[A-Za-z0-9+/_=-]{3,}")
        n = [Markov.counts([]).ravel(), Markov.counts([]).ravel()]
        for f in frames:
            for text in f["text"]:
                spans, good, at = base_spans(text), [], 0
                for s, _, e in [*spans, (len(text), 0, len(text))]:
                    good += [t for t in word.findall(text[at:s]) if len(t) < 16 or not any(map(str.isdigit, t))] if s > at else []
                    at = max(at, e)
                n[0] += Markov.counts(good).ravel()
                n[1] += Markov.counts([t for s, _, e in spans for t in word.findall(text[s:e])[-1:]]).ravel() if spans else 0
        yield pd.DataFrame({"cell": np.arange(len(n[0])), "good": n[0], "bad": n[1]})

    # by hash, where the documents lie: texts need not move
    share = min(1.0, SAMPLE_ROWS / max(1, docs.count()))
    sample = docs.where("text is not null").where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).select("text")
    counts = sample.mapInPandas(label, "cell int, good double, bad double").groupBy("cell").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).toPandas()
    n = len(ALPHABET)
    good, bad = np.zeros((n + 1) * n), np.zeros((n + 1) * n)
    good[counts["cell"]], bad[counts["cell"]] = counts["good"], counts["bad"]
    return Markov(bad.reshape(n + 1, n) * 0.1 + Markov.counts(random_strings())), Markov(good.reshape(n + 1, n) + Markov.counts(identifiers()))


def find(text: str, noise: Markov, plain: Markov) -> tuple[list[tuple[int, int, int]], list[tuple[int, str, int]]]:
    """Base spans, and all spans as ``(start, kind, end)``.

    Tokens and base spans are both in order: those base spans that start before a token's end overlap it
    where the farthest of their ends lies beyond its start.
    """
    base = base_spans(text)
    spans = [(s, KINDS[k], e) for s, k, e in base]
    at, farthest = 0, 0
    for m in TOKEN.finditer(text):
        s, e = m.span()
        while at < len(base) and base[at][0] < e:
            farthest = max(farthest, base[at][2])
            at += 1
        if farthest > s:
            continue
        least = LEAST_GAIN if any(map(str.isdigit, m[0])) else LEAST_GAIN_LETTERS
        if gain(m[0], noise, plain) >= least:
            spans.append((s, "random", e))
    order = {k: i for i, k in enumerate((*KINDS, "random"))}
    return base, sorted(spans, key=lambda x: (x[0], order[x[1]]))


def blotted(text: str, spans: list[tuple[int, str, int]]) -> str:
    """The text with ``[SECRET]`` for each run of overlapping spans."""
    parts, at = [], 0
    for s, _, e in spans:
        if s >= at:
            parts += [text[at:s], "[SECRET]"]
        at = max(at, e)
    return "".join([*parts, text[at:]])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", models: tuple[Markov, Markov] | None = None) -> DataFrame:
    """``(id, n_assign, n_access, n_hex, base_sha256, spans, redacted)``, one row for each row of ``docs``.

    Null texts count as empty (and stay null in ``redacted``, which has ``[SECRET]`` for each run of spans). Repeated rows
    repeat; other columns are ignored; no rows give no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    noise, plain = models or train(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, sums, all_spans, clean = [[], [], []], [], [], []
            for cell in batch.column("text"):
                text = cell.as_py()
                base, spans = find(text or "", noise, plain)
                for k in range(3):
                    n[k].append(sum(x[1] == k for x in base))
                sums.append(hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in base).encode()).hexdigest())
                all_spans.append(",".join(f"{k}:{s}:{e}" for s, k, e in spans))
                clean.append(blotted(text, spans) if spans else text)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(x, pa.int64()) for x in n), *(pa.array(x, pa.string()) for x in (sums, all_spans, clean))], ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "redacted"])

    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, redacted string")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """``docs`` with secrets blotted out of the texts, and the new number of characters where a text changed and ``size_col`` is there.

    Every row stays, repeated ones too, with all its columns, whatever their names. Null and empty texts
    stay as they are, and so does the size of an unchanged text (null included). Of spans that overlap or
    start together one ``[SECRET]`` is left. No rows give no rows.
    """
    columns = docs.columns
    noise, plain = train(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, changed = [], []
            for cell in batch.column(text_col):
                text = cell.as_py()
                spans = find(text, noise, plain)[1] if text else []
                texts.append(blotted(text, spans) if spans else text)
                changed.append(bool(spans))
            new = {text_col: pa.array(texts, batch.schema.field(text_col).type)}
            if size_col in columns:
                sizes = [len(t) if c else x.as_py() for t, c, x in zip(texts, changed, batch.column(size_col), strict=True)]
                new[size_col] = pa.array(sizes, batch.schema.field(size_col).type)
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in columns], columns)

    return docs.mapInArrow(run, docs.schema)
