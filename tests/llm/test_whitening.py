import math
import random

import numpy as np

from routelytics.llm import whitening as q

SCHEMA = "vec_id long, embedding array<float>, hi string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)


def brute(rows):
    """Exact sums in Python integers, plain covariance of all remaining rows."""
    left = [(i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([v for _, v in left], object)
    n, s = len(x), x.sum(axis=0)
    d = ((x * n - s) / n).astype(float)
    cov = d.T @ d / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    return left, n, [int(sum(v * v for v in row)) for row in x * n - s], d, e, u, np.trace(cov)


def vectors(seed, n=300, d=12):
    rng = random.Random(seed)
    base = [[rng.gauss(0, 1 / (k + 1)) for k in range(d)] for _ in range(n)]
    rows = list(enumerate(base))
    rows += [(1000 + i, base[0]) for i in range(n // 2)]  # a third of the rows share one vector
    return rows + [(1, base[1]), (None, base[2]), (None, base[2])]


def check(got, rows, k=8):
    left, n, dev, d, e, u, trace = brute(rows)
    by = {}
    for r in got:
        assert r.n == n and r.identity_error < 1e-9
        assert abs(r.explained / (e[r.component - 1] / trace) - 1) < 1e-9
        by.setdefault(r.component, []).append(r)
    assert sorted(by) == list(range(1, k + 1))
    key = lambda t: (t[0] is None, t[0] or 0, t[1], t[2])
    for c, mine in by.items():
        z = d @ u[:, c - 1] / math.sqrt(e[c - 1])
        best = None
        for sign in (1, -1):
            want = sorted([(i, a, sign * b) for (i, _), a, b in zip(left, dev, z)], key=key)
            have = sorted([(r.vec_id, r.deviation, r.whitened) for r in mine], key=key)
            assert len(want) == len(have)
            if all(w[:2] == h[:2] and abs(w[2] - h[2]) < 1e-8 for w, h in zip(want, have)):
                best = sign
        assert best is not None, c


def test_matches_brute_force_with_copies_and_bad_rows(spark):
    rows = vectors(3) + [(5000, None), (5001, [None] + [0.0] * 11), (5002, [float("nan")] + [0.0] * 11), (5003, [float("inf")] * 12)]
    check(q.digest(table(spark, rows)).collect(), rows)


def test_fewer_dimensions_than_components(spark):
    rows = vectors(4, 60, 3)
    check(q.digest(table(spark, rows)).collect(), rows, k=3)


def test_edge_tables(spark):
    assert q.digest(table(spark, [])).collect() == []
    assert q.digest(table(spark, [(1, None), (2, [])])).collect() == []
    assert q.digest(table(spark, [(1, [1.0, 2.0])])).collect() == []           # no variance
    assert q.digest(table(spark, [(i, [1.0, 2.0]) for i in range(9)])).collect() == []
    odd = [(i, [float(i), float(i * i)]) for i in range(6)] + [(9, [1.0]), (10, [1e30, 0.0])]
    assert {r.vec_id for r in q.digest(table(spark, odd)).collect()} == set(range(6))


def test_large_numbers_stay_exact(spark):
    """Sums beyond 64 bits are exact; a deviation that fits no long is null."""
    rows = [(i, [float(2 ** 41 + 1024 * i), float(i % 3)]) for i in range(50)]
    got = {r.vec_id: r.deviation for r in q.digest(table(spark, rows)).collect()}
    left, _, dev, *_ = brute(rows)
    assert got == {i: v if v < 1 << 63 else None for (i, _), v in zip(left, dev)}


def test_weights_of_one_count_each_vector_once(spark):
    rows = vectors(5, 40, 4)
    distinct = list({tuple(v): (i, v) for i, v in reversed(rows)}.values())
    a = {r.vec_id: r for r in q.whiten(table(spark, rows), q.WhitenParams(weights="one")).collect()}
    b = {r.vec_id: r for r in q.whiten(table(spark, distinct)).collect()}
    assert a[3].n == b[3].n == 40 and a[3].deviation == b[3].deviation
    assert np.allclose(np.abs(a[3].whitened), np.abs(b[3].whitened)) and a[1000].whitened == a[0].whitened


def test_each_distinct_vector_is_one_row(spark):
    got = q.whole_vectors(table(spark, vectors(6, 30, 4)), q.WhitenParams(), "embedding").groupBy("hi", "lo", "x").count()
    assert got.count() == 30 and got.agg({"count": "max"}).first()[0] == 16
