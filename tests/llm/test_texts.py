"""Operators 2, 4, 5, 6, 8, 9 and 10 against brute force, round trips and held-out accuracy, with odd rows."""

import hashlib
import random
import re

import numpy as np
import pytest

from tracelake.llm import langid, mixing, pieces, pii, quality, secrets, warc

ODD = [None, "", " ", "a", "\U0001f600 +49 30 1234567 x@y.z \U0001f600", "a@b.c.d%e@f.g x@y", "1.2.3.4.5.6.7.8.9 256.1.1.1 001.02.3.4", "4111 1111 1111 1111, 4111-1111-1111-1111, 12--4111111111111111", "x" * 200_000, "1." * 50_000, "+1 (017) 555-7713"]
BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= sum(c.isdigit() for c in m) <= 19 and luhn(m)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= sum(c.isdigit() for c in m) <= 15),
}


def luhn(m):
    d = [int(c) for c in m if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else (x * 2 - 9 if x > 4 else x * 2) for i, x in enumerate(d)) % 10 == 0


def spans(text, rules):
    out = sorted((m.start(), k, name, m.end()) for k, (name, (p, ok)) in enumerate(rules.items()) for m in re.finditer(p, text or "") if ok(m.group()))
    return ",".join(f"{n}:{s}:{e}" for s, _, n, e in out)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_pii(spark):
    r = random.Random(1)
    rows = [*ODD] + ["".join(r.choice("1234 .-+@ab()") for _ in range(250)) for _ in range(60)]
    rows += ["call (555) 123-4567 now", "my ssn 123-45-6789", "write bob (at) example (dot) com", "order 123-45-6789"]
    docs = [(i, t, "e", 1) for i, t in enumerate(rows)] + [(4, ODD[4], "e", 1)]
    got = pii.find(spark.createDataFrame(docs, "doc_id long, text string, kind string, start int")).collect()
    assert len(got) == len(docs)
    for x in got:
        base = spans(rows[x.id], BASE)
        assert x.base_sha256 == sha(base)
        assert set(filter(None, base.split(","))) <= set(x.spans.split(","))
        assert [x.n_email, x.n_ip, x.n_card, x.n_phone] == [sum(s.startswith(k + ":") for s in base.split(",")) for k in BASE]
    assert pii.find(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def iban(r):
    body = "".join(r.choices("0123456789", k=18))
    check = 98 - int(body + "131400") % 97  # DE
    whole = f"DE{check:02d}{body}"
    return whole if r.random() < 0.5 else " ".join(whole[i : i + 4] for i in range(0, 22, 4))


def labelled_texts(n=900):
    """Texts with one number or name each, and what they hold: personal data that no base rule takes, or a look-alike (None)."""
    r, out = random.Random(12), []
    digits = lambda k: "".join(r.choices("0123456789", k=k))
    prose = lambda: " ".join("".join(r.choices(["th", "er", "an", "so", "li", "men"], k=r.randint(1, 3))) for _ in range(r.randint(4, 12)))
    ssn = lambda: f"{r.randint(101, 599)}-{r.randint(10, 99)}-{r.randint(1000, 9999)}"
    phone = lambda: f"({r.randint(200, 989)}) {r.randint(200, 989)}-{digits(4)}"
    name = lambda: "".join(r.choices("abcdefghij", k=r.randint(3, 60)))
    makers = [
        ("ssn", lambda: (r.choice(["my ssn is ", "social security number: ", "his identity, ", "SSN "]), ssn())),
        ("local_phone", lambda: (r.choice(["call me on ", "phone: ", "tel. ", "mobile "]), phone())),
        ("hidden_email", lambda: (r.choice(["write to ", "mail ", "contact: ", ""]), f"{name()} (at) {name()} (dot) {r.choice(['com', 'org', 'de'])}")),
        ("hidden_email", lambda: (r.choice(["e-mail: ", "reach me: "]), f"{name()}[at]{name()}.{r.choice(['net', 'fr'])}")),
        ("iban", lambda: (r.choice(["account ", "IBAN: ", "transfer to ", ""]), iban(r))),
        (None, lambda: (r.choice(["invoice no. ", "order ", "part "]), f"{r.choice(['000', '666', '9' + digits(2)])}-{digits(2)}-{digits(4)}")),
        (None, lambda: (r.choice(["article ", "serial=", "version/"]), f"{r.randint(100, 199)} {r.randint(100, 199)}-{digits(4)}")),
        (None, lambda: (r.choice(["tracking ", "ref="]), f"DE{digits(2)}{digits(18)}")),
        (None, lambda: ("barcode ", "1" + digits(15))),
        (None, lambda: ("", f"{name()} [at] {name()}.{digits(3)}")),
        ("email", lambda: (r.choice(["mail ", ""]), f"{name()}@{name()}.com")),
        ("phone", lambda: (r.choice(["call ", ""]), f"+49 {digits(3)} {digits(7)}")),
    ]
    for k in range(n):
        kind, make = makers[k % len(makers)]
        cue, what = make()
        out.append((f"{prose()} {cue}{what} {prose()}", kind, what))
    return out


def test_pii_adds_what_the_labelers_agree_on(spark):
    rows = labelled_texts()
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(rows)], "doc_id long, text string").repartition(3)
    got = {x.id: x.spans for x in pii.find(docs).collect()}
    found, wanted, right = {}, {}, {}
    for i, (text, kind, what) in enumerate(rows):
        at = text.index(what)
        if kind not in (None, *pii.BASE):
            wanted[kind] = wanted.get(kind, 0) + 1
        for k, s, e in (x.split(":") for x in got[i].split(",") if x):
            if k not in pii.BASE:
                found[k] = found.get(k, 0) + 1
                right[k] = right.get(k, 0) + (k == kind and (int(s), int(e)) == (at, at + len(what)))
    print({k: (round(right.get(k, 0) / n, 3), round(right.get(k, 0) / max(1, found.get(k, 0)), 3)) for k, n in wanted.items()}, found)
    assert all(right.get(k, 0) >= 0.9 * n for k, n in wanted.items())  # recall of each kind
    assert sum(right.values()) >= 0.95 * sum(found.values())  # precision


def test_pii_labelers_differ_between_classes(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(labelled_texts())], "id long, text string")
    _, rates = pii.reliabilities(pii.materialize(pii.apart(pii.voted(pii.candidates(docs)))))
    print(rates)
    for name, (data, rest) in rates.items():
        assert sum(data) == pytest.approx(1) and sum(rest) == pytest.approx(1)
        assert name == "prose" or sum(abs(a - b) for a, b in zip(data, rest, strict=True)) > 0.1


BASE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
p AS (SELECT * FROM (VALUES ('email', 0, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+'), ('ip', 1, '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+'), ('card', 2, '[0-9](?:[ -]?[0-9])+'), ('phone', 3, '\+[0-9][ ().0-9-]+[0-9]')) AS x(kind, rank, pattern)),
m AS (SELECT doc_id, kind, rank, regexp_extract_all(t, pattern) AS found, regexp_split_to_array(t, pattern) AS gaps FROM d, p),
s AS (SELECT doc_id, kind, rank, found[i] AS match, list_sum(list_transform(range(1, i + 1), lambda k: length(gaps[k]) + CASE WHEN k < i THEN length(found[k]) ELSE 0 END)) AS start FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM m)),
g AS (SELECT *, regexp_replace(match, '[^0-9]', '', 'g') AS digits FROM s),
h AS (SELECT *, list_sum(list_transform(range(1, len(digits) + 1), lambda k: CASE WHEN k % 2 = 1 THEN CAST(reverse(digits)[k] AS INT) ELSE (CAST(reverse(digits)[k] AS INT) * 2) // 10 + (CAST(reverse(digits)[k] AS INT) * 2) % 10 END)) AS luhn FROM g),
k AS (SELECT * FROM h WHERE CASE kind WHEN 'email' THEN true WHEN 'ip' THEN list_max(list_transform(string_split(match, '.'), lambda x: CAST(x AS HUGEINT))) <= 255 WHEN 'card' THEN len(digits) BETWEEN 14 AND 19 AND luhn % 10 = 0 ELSE len(digits) BETWEEN 10 AND 15 END)
SELECT d.doc_id, coalesce(count_if(kind = 'email'), 0) AS n_email, coalesce(count_if(kind = 'ip'), 0) AS n_ip, coalesce(count_if(kind = 'card'), 0) AS n_card, coalesce(count_if(kind = 'phone'), 0) AS n_phone,
  sha256(coalesce(string_agg(concat(kind, ':', start, ':', start + length(match)), ',' ORDER BY start, rank) FILTER (WHERE kind IS NOT NULL), '')) AS base_sha256 FROM d LEFT JOIN k USING (doc_id) GROUP BY 1
"""


def test_pii_base_columns_equal_sql(spark):
    import duckdb

    from tracelake.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = sorted((i, *map(int, n), h) for i, *n, h in db.execute(BASE_SQL).fetchall())
    got = QUERIES["op2_pii"](spark, folder).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256").collect()
    assert sorted(map(tuple, got)) == want and sum(w[1] for w in want) > 0


def test_secrets(spark):
    rules = {
        "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(re.search(r"""[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$""", m)[1]) >= 12),
        "access": (r"AKIA[A-Z0-9]+", lambda m: len(m) >= 18),
        "hex": (r"[0-9a-f]+", lambda m: len(m) >= 16),
    }
    rows = [*ODD, "token = \"f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda\" x", "API_KEY: 'abc' passwd=abcdefghijkl", "AKIA" + "Z" * 14, "AKIA1", "PassWord:abcdefghijklmnop and 0123456789abcdef0", "key ghp16C7e42F292c6912E7710c838347Ae178B4a end"]
    docs = [(i, t, "z") for i, t in enumerate(rows)] + [(3, "a", "z")]
    got = secrets.scan(spark.createDataFrame(docs, "doc_id long, text string, spans string")).collect()
    assert len(got) == len(docs)
    for x in got:
        assert x.base_sha256 == sha(spans(rows[x.id], rules)), x
        assert set(filter(None, spans(rows[x.id], rules).split(","))) <= set(x.spans.split(","))
    last = max(got, key=lambda x: x.id)
    assert last.spans == "random:4:43" and last.redacted == "key [SECRET] end"
    assert secrets.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_redaction_keeps_documents(spark):
    docs = spark.createDataFrame([(1, "ok text", "en", "s", 7), (2, "token = abcdefghijklmnop!", "en", "s", 25), (3, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in secrets.redact(docs).collect()}
    assert got[1].text == "ok text" and got[2].text == "[SECRET]!" and got[2].n_chars == 9 and got[3].text is None


def labelled_tokens(n=1000):
    """Tokens that no base rule takes: random keys (True), and ordinary identifiers and words (False)."""
    r, out = random.Random(77), []
    parts = "account report parse shadow window render signal frame vector merge cache token buffer stream handler widget cursor commit socket filter".split()
    sets = ["ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]
    for k in range(n):
        words = r.choices(parts, k=r.randint(3, 5))
        style = ("_".join(words), "-".join(words), "".join(w.title() for w in words), "_".join(words).upper() + "_" + str(r.randint(1, 2030)), "/".join(words))[k % 5]
        out.append(("".join(r.choices(sets[k // 2 % 4], k=r.randint(24, 44))), True) if k % 2 else (style, False))
    return [(t, x) for t, x in out if len(t) >= 16 and not secrets.base_spans(t)]


def test_added_secrets_precision_and_recall():
    models = secrets.Markov(secrets.Markov.counts(secrets.random_strings())), secrets.Markov(secrets.Markov.counts(secrets.identifiers()))
    tokens = labelled_tokens()
    found = [(x, len(secrets.find(f"see {t} here", *models)[1])) for t, x in tokens]
    hits = sum(n for x, n in found if x)
    print("recall", hits / sum(x for _, x in tokens), "precision", hits / sum(n for _, n in found))
    assert hits >= 0.9 * sum(x for _, x in tokens) and hits >= 0.97 * sum(n for _, n in found)


def test_secrets_of_a_long_list_take_linear_time():
    import time

    models = secrets.Markov(secrets.Markov.counts(secrets.random_strings(400))), secrets.Markov(secrets.Markov.counts(secrets.identifiers(400)))
    took = []
    for n in (4_000, 16_000):
        text = " ".join(hashlib.md5(str(i).encode()).hexdigest() for i in range(n))
        began = time.process_time()
        base, spans = secrets.find(text, *models)
        took.append(time.process_time() - began)
        assert len(base) == len(spans) == n
    assert took[1] < 9 * took[0]


def test_redaction_with_odd_columns(spark):
    rows = [(1, "token = abcdefghijklmnop!", 3, "x"), (1, "token = abcdefghijklmnop!", 3, "x"), (None, None, None, None), (2, "", 9, "y")]
    got = secrets.redact(spark.createDataFrame(rows, "doc_id long, text string, spans int, redacted string")).collect()
    assert [tuple(r) for r in got] == [(1, "[SECRET]!", 3, "x"), (1, "[SECRET]!", 3, "x"), (None, None, None, None), (2, "", 9, "y")]
    assert secrets.redact(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.fixture(scope="module")
def prose():
    r = random.Random(3)
    syllables = {"en": ["th", "e", "and", "ing", "ou", "er"], "de": ["sch", "ei", "ung", "ß", "ver", "ch"], "fr": ["é", "eau", "que", "oi", "la", "ç"]}
    return [(i, " ".join("".join(r.choices(syllables[lang], k=r.randint(1, 4))) for _ in range(r.randint(20, 60))), lang) for i in range(400) for lang in [r.choice(list(syllables))]]


def test_quality(spark, prose):
    r = random.Random(4)
    bad = [(1000 + i, " ".join(w + r.choice(["$$$", "###"]) for w in t.split())) for i, t, _ in prose[:60]] + [(2000 + i, " ".join([w] * 60)) for i, (_, t, _) in enumerate(prose[:20]) for w in t.split()[:1]]
    docs = [(i, t) for i, t, _ in prose] + bad + [(5000, None), (5001, ""), (5002, "x"), (None, "some words here"), (1, prose[1][1])]
    labels = [(i, 1, 0) for i, _, _ in prose[:150]] + [(i, 0, 0) for i, _ in bad[::2]] + [(2, 0, 0), (2, 1, 0), (None, 1, 0), (3, None, None)]
    frame = spark.createDataFrame([(i, t, 0.5) for i, t in docs], "doc_id long, text string, log_weight double")
    got = quality.resample(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(docs)
    kept = {x.id for x in got if x.kept}
    assert len(kept & {i for i, _, _ in prose}) >= 0.95 * len(prose)
    assert len(kept & {i for i, _ in bad}) <= 0.1 * len(bad)
    assert not kept & {5000, 5001, 5002}
    assert quality.resample(frame.limit(0), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


def plain_buckets(text):
    """The buckets that a text's n-grams fall in, one n-gram at a time."""
    b, out = (text or "").encode(), []
    for n in quality.ORDERS:
        for i in range(len(b) - n + 1):
            code = 0
            for x in b[i : i + n]:
                code = (code * 257 + x) % 2**32
            out.append((code * 2654435761 + n * 40503) % 2**32 >> 17)
    w = (text or "").split()
    same = [a == x for a, x in zip(w, w[1:], strict=False)]
    return out + [quality.HASHED + 4 * a + 2 * b2 + c for a, b2, c in zip(same, same[1:], same[2:], strict=False)]


def test_quality_against_plain_counts(spark):
    from collections import Counter
    from math import log

    r = random.Random(14)
    rows = [(i, " ".join(r.choices(["aa", "bé", "c#", "dd dd", "e"], k=r.randint(0, 12)))) for i in range(60)] + [(70, None), (71, ""), (72, "x"), (3, "twice"), (73, "s s s s s s")]
    good = set(range(0, 60, 2))
    labels = [(i, int(i in good), 0) for i in range(60)]
    got = quality.resample(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    counts = {k: Counter() for k in ("raw", "target")}
    for i, t in rows:
        counts["raw"].update(plain_buckets(t))
        if i in good:
            counts["target"].update(plain_buckets(t))
    total = {k: sum(c.values()) + quality.SMOOTH * quality.BUCKETS for k, c in counts.items()}
    ratio = lambda b: log((counts["target"][b] + quality.SMOOTH) / total["target"]) - log((counts["raw"][b] + quality.SMOOTH) / total["raw"])
    want = sorted((i, sum(map(ratio, plain_buckets(t))) if plain_buckets(t) else None) for i, t in rows if i != 3)
    assert [(x.id, x.log_weight) for x in sorted(got, key=lambda x: x.id) if x.id != 3] == [(i, w if w is None else pytest.approx(w)) for i, w in want]
    known = {i: w for i, w in want if w is not None}
    bad, fine = [known[i] for i in known if i < 60 and i not in good], [known[i] for i in known if i in good]
    level = sorted(fine)[0] if max(bad) >= sorted(fine)[0] else None
    kept = [x for x in got if x.kept]
    keys = sorted((x.gumbel_key for x in got if x.gumbel_key is not None), reverse=True)
    if level is not None:
        k = sum(x.log_weight is not None and x.log_weight >= level - 1e-9 for x in got)
        assert len(kept) == k and min(x.gumbel_key for x in kept) == keys[k - 1]


def test_kth_largest(spark):
    r = random.Random(5)
    for values in ([1.0] * 50, [r.gauss(0, 1) for _ in range(30_000)], [1e300, -1e300, 0.0, None]):
        f = spark.createDataFrame([(v,) for v in values], "x double")
        want = sorted((v for v in values if v is not None), reverse=True)
        for k in {1, 2, len(want) // 2 + 1, len(want)}:
            assert quality.kth_largest(f, "x", k) == want[k - 1]


def water(sizes, weights):
    """Targets by repeated resharing."""
    target, open_, left = dict.fromkeys(sizes, 0.0), set(sizes), float(sum(sizes.values()))
    while left > 1e-9 and open_:
        total = sum(weights[s] for s in open_)
        over = 0.0
        for s in sorted(open_, key=str):
            target[s] += left * weights[s] / total
        for s in list(open_):
            if target[s] >= 3 * sizes[s]:
                over += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.discard(s)
        left = over
    return target


def test_mixing(spark):
    r = random.Random(6)
    docs = [(i, " ".join(["w"] * r.randint(0, 40)), s) for i, s in enumerate(r.choices(["a", "b", "c", "d", None, ""], [50, 10, 3, 1, 5, 2], k=600))]
    docs += [(9000, None, "a"), (9001, "", "z"), (1, docs[1][1], docs[1][2])]
    frame = spark.createDataFrame([(i, t, s, 1, 2) for i, t, s in docs], "doc_id long, text string, source string, size int, taken int")
    got = mixing.mix(frame).collect()
    assert len(got) == len(docs)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(frame.repartition(7)).collect()))
    names = sorted({s for _, _, s in docs if s is not None}) + [None]
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    sizes = {s: sum(len((t or "").split()) for _, t, x in docs if x == s) for s in names}
    target = water(sizes, weights)
    for s in names:
        mine = [x for x in got if x.source == s]
        assert all(abs(x.target - target[s]) < 1e-6 and x.source_size == sizes[s] and 0 <= x.taken <= 3 * x.size for x in mine)
        assert abs(sum(x.taken for x in mine) - target[s]) <= 1
    rows = mixing.mixed_rows(frame).collect()
    assert {x.doc_id for x in rows} <= {x.doc_id for x in got} and len(rows) > 0
    slim = {(x.doc_id, x.taken) for x in mixing.mix(frame, slim=True).collect()}
    assert len(slim) >= len({i for i, *_ in docs})
    assert mixing.mix(frame.limit(0)).count() == 0


def test_mixed_rows_keep_clashing_columns(spark):
    docs = [(1, "a b c d", "s", "big", 7, "orig", 1), (1, "a b c d", "s", "big", 7, "orig", 1), (2, "e f", "t", None, None, None, None), (None, "g", None, "x", 0, "y", 2), (None, "h", None, "x", 0, "y", 2), (3, None, "s", "", 1, "", 3)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, size string, copies int, copy string, _nth int")
    rows = mixing.mixed_rows(frame)
    assert rows.schema == frame.schema
    assert {tuple(r) for r in rows.collect()} <= set(docs) and rows.count() > 0
    assert mixing.once(frame, "doc_id").columns == frame.columns
    assert sorted(map(str, map(tuple, mixing.once(frame, "doc_id").collect()))) == sorted(map(str, docs[1:]))
    assert mixing.mixed_rows(frame.limit(0)).count() == 0


def test_sources_are_numbered_by_name_in_ranges(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 7)
    names = [f"h{i * 7919 % 101}" for i in range(101)] + [None, "", "\U0001f600", "\uffff", "z"]
    got = mixing.numbered(spark.createDataFrame([(n, 1) for n in names], "source string, source_size long")).collect()
    order = sorted((n for n in names if n is not None), key=lambda n: n.encode()) + [None]
    assert {r.source: r.nth for r in got} == {n: i for i, n in enumerate(order)}


def test_many_sources_meet_their_targets(spark):
    r = random.Random(15)
    sizes = {f"h{i:03d}": r.choice([1, 5, 50, 4000]) for i in range(200)}
    got = {x.source: x.target for x in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    want = water(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes))})
    assert got == {s: pytest.approx(t) for s, t in want.items()}


def test_mixing_prefers_quality(spark):
    docs = [(i, ("good words " if i % 2 else "### $$$ ") * 10, "a") for i in range(400)] + [(1000 + i, "w w", "b") for i in range(400)]
    got = mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string")).where("source = 'a'").collect()
    assert all(x.mix_key > 0 for x in got)
    mean = lambda odd: np.mean([x.mix_key for x in got if x.doc_id % 2 == odd])
    assert mean(1) < mean(0)


def every_segmentation(v, text):
    out, s = [], " " + text

    def go(i, score, ids):
        if i == len(s):
            out.append((score, ids))
            return
        for j in range(i + 1, min(i + v.longest, len(s)) + 1):
            if s[i:j] in v.pieces:
                go(j, score + v.pieces[s[i:j]][1], [*ids, v.pieces[s[i:j]][0]])
        if s[i] not in v.pieces:
            b = s[i].encode()
            go(i + 1, score + v.byte_score * len(b), ids + [v.bytes[x] for x in b])

    go(0, 0.0, [])
    return sorted(out, key=lambda x: -x[0])


def test_n_best_segmentations(spark):
    v = pieces.Vocabulary(pieces.default_model())
    rows = [None, "", "Hello wor", "  a  b", "x▁y\nz", "ünïcode", "aaaaaaaa", "\U0001f600 q", "x" * 20_000, " ".join(["word"] * 5000)]
    frame = spark.createDataFrame([(i, t, [1]) for i, t in enumerate(rows)], "doc_id long, text string, ids array<int>")
    got = {r.id: r for r in pieces.encode(frame).collect()}
    for i, t in enumerate(rows):
        assert v.decode(got[i].ids) == (t or "")
        assert all(v.decode(b["ids"]) == (t or "") for b in got[i].n_best)
        assert len({tuple(b["ids"]) for b in got[i].n_best}) == len(got[i].n_best)
        if t and len(t) < 12:
            want = every_segmentation(v, t)[:4]
            assert [b["score"] for b in got[i].n_best] == pytest.approx([s for s, _ in want])
    digest = {r.id: r for r in pieces.encode(frame, digest=True).collect()}
    assert all(r.exact and r.n_pieces == len(got[i].ids) for i, r in digest.items())
    back = {r.id: r.text for r in pieces.decode(pieces.encode(frame)).collect()}
    assert back == {i: t or "" for i, t in enumerate(rows)}
    assert pieces.encode(frame.limit(0)).count() == 0


def test_language(spark, prose):
    extra = [(7000, None, "en"), (7001, "", "en"), (7002, "123 !?", "de"), (7003, prose[0][1], None), (None, prose[1][1], "fr"), (7004, "e" * 50_000, "en")]
    frame = spark.createDataFrame([(i, t, k, "und", 0.0) for i, t, k in prose + extra], "doc_id long, text string, lang string, lang_pred string, score double")
    got = langid.identify(frame).collect()
    assert len(got) == len(prose) + len(extra)
    truth = {i: k for i, _, k in prose}
    held = [x for x in got if x.held_out and x.id in truth]
    assert held and np.mean([x.lang_pred == truth[x.id] for x in held]) > 0.95
    assert {x.id: x.lang_pred for x in got if x.id in (7000, 7001, 7002)} == dict.fromkeys((7000, 7001, 7002), "und")
    assert all(0 <= x.score <= 1 for x in got)
    nothing = langid.identify(frame.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()
    assert {x.lang_pred for x in nothing} == {"und"}
    assert langid.identify(frame.limit(0)).count() == 0


def test_thirty_languages_and_scripts(spark):
    r = random.Random(21)
    scripts = [range(0x4E00, 0x4F00), range(0x0430, 0x0450), range(0x0E01, 0x0E30), range(0x0905, 0x0930), range(0x05D0, 0x05EA), range(0xAC00, 0xAD00)]
    langs, rows = {}, []
    for k in range(30):
        langs[f"l{k:02d}"] = ["".join(chr(r.choice(scripts[k % 6])) for _ in range(r.randint(1, 3))) for _ in range(25)]
    for i in range(1500):
        lang = f"l{i % 30:02d}" if i < 1440 else "l00"
        rows.append((i, " ".join(r.choices(langs[lang], k=25)), lang))
    rows += [(9000 + i, " ".join(r.choices(langs["l29"], k=25)), "rare") for i in range(3)]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)).collect()
    truth = {i: k for i, _, k in rows}
    held = [x for x in got if x.held_out and truth[x.id] != "rare"]
    print("held-out accuracy of 30 languages", np.mean([x.lang_pred == truth[x.id] for x in held]))
    assert np.mean([x.lang_pred == truth[x.id] for x in held]) > 0.95


def test_letters_are_letters():
    assert not any(map(langid.has_letter, ["", "² ①", "12 ½ Ⅷ", "_\u0301 \U0001f600"])) and all(map(langid.has_letter, ["ª", "中", "1a", "ǅ", "ʰ"]))


def test_transitions_are_counted_by_token():
    tokens = ["abc", "a", "Zz9", "abab", "=="]
    plain = np.zeros((len(secrets.ALPHABET) + 1, len(secrets.ALPHABET)))
    for t in tokens:
        for before, c in zip([None, *t], t, strict=False):
            plain[len(secrets.ALPHABET) if before is None else secrets.ALPHABET.index(before), secrets.ALPHABET.index(c)] += 1
    assert np.array_equal(secrets.Markov.counts(tokens), plain) and not secrets.Markov.counts([]).any()


def test_character_grams():
    at, n = langid.grams("ДА да")
    assert n.sum() == 5 + 4 + 3
    assert set(langid.grams("да")[0]) <= set(at) and not np.array_equal(langid.grams("中")[0], langid.grams("国")[0])
    assert np.array_equal(langid.grams("a1b")[0], langid.grams("a b")[0])


def test_warc(spark, monkeypatch):
    monkeypatch.setattr(warc, "FRAME", 500)
    pages = [(i, f"http://h/{i}\r\nX: y", h) for i, h in enumerate(["<p>a</p>", "<p>b</p>", "<p>a</p>", None, "", "é" * 3000, "a\r\n\r\nWARC/1.1", "<p>a</p>"])] + [(8, None, "z"), (8, None, "z"), (None, "u", "v")]
    frame = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, kind string, first int")
    folder, contents = warc.archive(frame)
    got = {r.page_id: r for r in warc.inspect(warc.read_bundles(spark, folder, contents)).collect()}
    html = {i: (h or "").encode() for i, _, h in pages if i is not None}
    assert set(got) == set(html)
    for i, h in html.items():
        first = min(j for j, x in html.items() if x == h)
        assert got[i].payload_bytes == len(h) and got[i].refers_to == (None if i == first else first)
        assert got[i].record_type == ("response" if i == first else "revisit")
    for row in contents.collect():
        headers, block = warc.fetch(folder, row)
        assert headers["warc-record-id"] == f"<urn:page:{row.page_id}>"
        assert block == (html[row.page_id] if headers["warc-type"] == "response" else b"")
    empty = warc.archive(frame.limit(0))
    assert empty[1].count() == 0


def test_pipeline_imports_and_orders_stages():
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "secrets", "mixing", "encoding"]
