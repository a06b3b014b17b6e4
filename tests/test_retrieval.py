"""Nearest vectors by pivots and rings against comparing all."""

import numpy as np
import pytest

from tracelake.operators import retrieval as I


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_nearest_as_brute_force(spark, spread):
    r = np.random.default_rng(2)
    centres = r.standard_normal((6, 12))
    x = (centres[r.integers(0, 6, 500)] + spread * r.standard_normal((500, 12))).astype(np.float32)
    x[7] = x[9]
    rows = [(i, v.tolist(), i * 10, f"d{i % 3}") for i, v in enumerate(x)] + [(900, None, 0, "d0"), (901, [0.0] * 12, 0, "d0"), (902, [float("nan")] * 12, 0, "d0"), (903, [None, *[1.0] * 11], 0, "d0")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, timestamp_ms long, dataset_name string").repartition(3)
    q = np.concatenate([x[::25].astype(float), r.standard_normal((5, 12))])
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)] + [(99, [0.0] * 12)], "query_id long, q array<double>")
    for kw, ok in (({}, np.ones(500, bool)), ({"start": 500, "stop": 4000, "datasets": ["d1"]}, np.array([500 <= i * 10 <= 4000 and i % 3 == 1 for i in range(500)]))):
        got = {}
        for row in I.nearest(vectors, queries, 7, **kw).collect():
            got.setdefault(row.query_id, {})[row.nth] = (row.vec_id, row.similarity)
        assert set(got) == set(range(len(q)))
        y = x.astype(float)
        cos = (q @ y.T) / np.linalg.norm(q, axis=1)[:, None] / np.linalg.norm(y, axis=1)
        for i in range(len(q)):
            want = sorted((-round(cos[i, j], 12), j) for j in np.flatnonzero(ok))[:7]
            assert [got[i][n][1] for n in range(1, 8)] == pytest.approx([-c for c, _ in want])
            assert [got[i][n][0] for n in range(1, 8)] == [j for _, j in want]


def test_few_vectors_and_quota(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    queries = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(1500)], "query_id long, q array<double>")
    assert I.nearest(vectors, queries, 5).count() == 3000
    assert I.nearest(vectors.limit(0), queries, 5).count() == 0 and I.nearest(vectors, queries.limit(0), 5).count() == 0
    quota = I.Quota(single=10, total=25)
    quota.take(10)
    quota.take(10)
    with pytest.raises(ValueError, match="5 of 25"):
        quota.take(10)
    with pytest.raises(ValueError, match="10 at most"):
        I.nearest(vectors, queries, 11, quota=quota)
