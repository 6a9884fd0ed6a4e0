from __future__ import annotations

from collections import Counter

import numpy as np

from tallyward.llm.vectors import NearVectors


def usable(v, label):
    return (
        label is not None and v is not None and len(v) > 0 and all(x is not None for x in v)
        and bool(np.isfinite(v).all()) and any(v)
    )


def brute(rows, least=0.98):
    n, label = len(rows), list(range(len(rows)))
    links = [0] * n

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(n):
        for j in range(i):
            (_, a, x), (_, b, y) = rows[i], rows[j]
            if not (usable(a, x) and usable(b, y) and x == y and len(a) == len(b)):
                continue
            u, v = np.array(a, float), np.array(b, float)
            if u @ v / np.sqrt((u @ u) * (v @ v)) >= least:
                links[i] += 1
                links[j] += 1
                label[max(root(i), root(j))] = min(root(i), root(j))
    ids = {}
    for i, (key, _, _) in enumerate(rows):
        if key is not None:
            ids[root(i)] = min(key, ids.get(root(i), key))
    return Counter(
        (key, links[i], ids.get(root(i)), key == ids.get(root(i))) for i, (key, _, _) in enumerate(rows)
    )


def test_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(12):
        centre = rng.standard_normal(16)
        for _ in range(rng.integers(1, 12)):
            v = centre + rng.standard_normal(16) * rng.choice([0, 0.02, 0.05, 0.08])
            rows.append([len(rows), [float(x) for x in v.astype(np.float32)], int(c % 3)])
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = Counter(tuple(r) for r in NearVectors().classes(df).collect())
    assert got == brute([(k, v, x) for k, v, x in rows])


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [1.0, nan], 1),
        (6, [1.0, inf], 1), (7, [1.0, 2.0], None), (8, [1.0, 2.0], 1), (9, [2.0, 4.0], 1),
        (9, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (10, [1.0, 2.0, 0.0], 1), (11, [-0.0, 5.0], 2),
        (12, [0.0, 5.0], 2), (13, [1e200, 2e200], 1), (14, [1e-200, 2e-200], 1), (None, [9.0, 1.0], 7),
    ]
    df = spark.createDataFrame(
        [(*r, 0) for r in rows], "vec_id bigint, embedding array<double>, label int, node int"
    )
    got = Counter(tuple(r) for r in NearVectors().classes(df).collect())
    small = [(k, [x / max(map(abs, v)) for x in v] if k in (13, 14) else v, x) for k, v, x in rows]
    assert got == brute(small)
    assert NearVectors().classes(df.limit(0)).count() == 0


def test_recall_of_planted_pairs(spark):
    """Pairs of 64 dimensions at cosines just above the threshold; at least 0.99 must be found."""
    rng = np.random.default_rng(11)
    rows, n = [], 400
    for i in range(n):
        u = rng.standard_normal(64)
        w = rng.standard_normal(64)
        w -= u * (u @ w) / (u @ u)
        u, w = u / np.linalg.norm(u), w / np.linalg.norm(w)
        cosine = rng.uniform(0.9801, 0.984)
        v = cosine * u + np.sqrt(1 - cosine**2) * w
        rows += [(2 * i, u.tolist(), 1), (2 * i + 1, (v * 3).tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = NearVectors().classes(df).collect()
    found = sum(r.n_links for r in got) / 2
    assert 0.99 * n <= found <= n
