"""Each pipeline stage against brute force on its own input."""

import random

import pytest

import corpus_pipeline as C
from tracelake.llm import pieces, secrets


def words(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = random.Random(8)
    parts = ["th", "e", "and", "ing", "ou", "er", "re", "on"]
    prose = lambda n: " ".join("".join(r.choices(parts, k=r.randint(1, 4))) for _ in range(n))
    rows, labels = [], []
    for i in range(160):
        rows.append((i, prose(r.randint(30, 80)), "en", r.choice("aabc"), 0))
        labels.append((i, 1, 0))
    for i in range(160, 200):  # junk
        rows.append((i, " ".join(w + r.choice(["$$$", "%%%", "###"]) for w in prose(60).split()), "en", "a", 0))
        labels.append((i, 0, 0))
    for k in range(6):  # a copy, and a near copy, of each
        rows.append((300 + k, rows[k][1], "en", "b", 0))
        changed = rows[k + 10][1].split()
        changed[-1] = "changed"
        rows.append((400 + k, " ".join(changed), "en", "c", 0))
    rows.append((500, rows[20][1] + ' token = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda" ' + prose(40), "en", "a", 0))
    rows.append((501, None, None, None, None))
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in C.STAGES:
        stage(spark, docs, str(folder)).write.parquet(f"{folder}/{name}")
        before, docs = docs, spark.read.parquet(f"{folder}/{name}")
        seen[name] = (before, docs)
    return seen, str(folder)


def test_quality_stage(corpus):
    before, after = corpus[0]["quality"]
    kept = {r.doc_id for r in after.collect()}
    assert after.columns == before.columns
    assert not kept & set(range(160, 200)) and 501 not in kept
    assert len(kept & set(range(160))) >= 158


def test_near_duplicate_stage(corpus):
    before, after = corpus[0]["near_dedup"]
    sets = {r.doc_id: words(r.text) for r in before.collect()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert {r.doc_id for r in after.collect()} == {i for i in sets if find(i) == i}
    assert after.columns == before.columns


def test_secret_stage(corpus):
    before, after = corpus[0]["secrets"]
    old, new = ({r.doc_id: r for r in f.collect()} for f in (before, after))
    assert set(old) == set(new)
    for i, r in new.items():
        text, at = [], 0
        for s, _, e in secrets.base_spans(old[i].text):
            text += [old[i].text[at:s], "[SECRET]"] if s >= at else []
            at = max(at, e)
        assert r.text == "".join([*text, old[i].text[at:]])
    assert "[SECRET]" in new[500].text


def test_mixing_stage(corpus):
    before, after = corpus[0]["mixing"]
    size = {r.doc_id: len(r.text.split()) for r in before.collect()}
    source = {r.doc_id: r.source for r in before.collect()}
    sizes = {s: sum(size[i] for i in size if source[i] == s) for s in set(source.values())}
    weights = dict(zip(sorted(sizes), (5, 2, 1), strict=False))
    total = sum(sizes.values())
    rows = [r.doc_id for r in after.collect()]
    assert set(rows) <= set(size) and max(map(rows.count, rows)) <= 3
    shares = {s: min(3 * sizes[s], total * weights[s] / sum(weights.values())) for s in sizes}
    rest = total - sum(shares.values())
    free = [s for s in sizes if shares[s] < 3 * sizes[s]]
    for s in free:
        shares[s] += rest * weights[s] / sum(weights[x] for x in free)
    for s in sizes:
        assert abs(sum(size[i] for i in rows if source[i] == s) - shares[s]) <= max(size.values())
    assert after.columns == before.columns


def test_encoding_stage(corpus):
    before, after = corpus[0]["encoding"]
    v = pieces.Vocabulary(pieces.default_model())
    assert sorted(v.decode(r.ids) for r in after.collect()) == sorted(r.text for r in before.collect())
    assert all(list(r.scores) == sorted(r.scores, reverse=True) for r in after.collect())


def test_run(spark, corpus):
    got = C.run(spark, corpus[1])
    assert got.columns == ["doc_id", "ids", "scores"] and got.count() == corpus[0]["encoding"][1].count()


def test_extra_columns_nulls_and_empty_tables(spark, tmp_path):
    """Columns that clash with the operators' own stay as they are; an empty table gives an empty result."""
    text = "the same few words are told again and again in another order here"
    rows = [(i, f"{text} {i * 7919 % 101} {i} " * 3, "en", "ab"[i % 2], 5, f"p{i}", i, "r", 0.5, "t", i, "k") for i in range(12)]
    rows += [(None, f"{text} without an id", None, None, None, "p", 1, "r", None, "t", 2, "k"), (3, None, None, None, None, None, None, None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, print string, id long, row string, size double, taken string, _id long, kept string"
    docs = spark.createDataFrame(rows, schema)
    spark.createDataFrame([(0, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    known = {tuple(r) for r in rows}
    for name, stage in C.STAGES:
        for n, frame in enumerate((docs, docs.limit(0))):
            out = stage(spark, frame, str(tmp_path))
            if name != "encoding":
                assert out.columns == docs.columns
                assert {tuple(r) for r in out.collect()} <= known if not n else out.count() == 0
            else:
                assert out.count() == (len(rows) if not n else 0)
