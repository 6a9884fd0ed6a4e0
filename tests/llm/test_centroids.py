from __future__ import annotations

import hashlib
import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tallyward.llm.centroids import Centres, CentroidClusters, Rotation


def brute(rows, clusters=8, rounds=10, size=64):
    """The rows (id, vector) by whole numbers of any size, one centroid after the other."""
    kept = [
        (key, [math.floor(Fraction(x) * 1024) for x in v])
        for key, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] is not None and sha(f"3:{r[0]}"), r[1]))
    centres = [v for _, v in order[:clusters]]

    def nearest(v):
        found = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
        return found.index(min(found)), min(found)

    for _ in range(rounds):
        mine = [nearest(v)[0] for _, v in kept]
        for c in range(len(centres)):
            members = [v for (_, v), m in zip(kept, mine) if m == c]
            if members:
                centres[c] = [sum(x) // len(members) for x in zip(*members)]
    final = [nearest(v) for _, v in kept]
    within = Counter()
    for c, d in final:
        within[c] += d
    long = lambda x: x if x < 1 << 63 else None
    return Counter(
        (key, c, long(d), long(within[c]), long(sum(within.values())), sha(",".join(map(str, centres[c]))))
        for (key, _), (c, d) in zip(kept, final)
    )


def rows_of(seed, n, size=64, groups=5, spread=0.05):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((groups, size))
    return [
        (i, [float(x) for x in (centre[i % groups] + spread * rng.standard_normal(size)).astype(np.float32)])
        for i in range(n)
    ]


def result(spark, rows, kind="float", **options):
    df = spark.createDataFrame(
        [(*r, 1, 2) for r in rows], f"vec_id bigint, embedding array<{kind}>, cluster int, id int"
    )
    return Counter(tuple(r) for r in CentroidClusters(**options).classes(df.repartition(5)).collect())


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_equals_brute_force(spark, spread):
    rows = rows_of(1, 90, spread=spread)
    assert result(spark, rows) == brute(rows)


def test_hot_group_and_repeated_rows(spark):
    rows = rows_of(2, 40)
    rows += [rows[0]] * 60 + [(7, rows[1][1]), (7, rows[2][1])]
    assert result(spark, rows) == brute(rows)


def test_rows_left_out(spark):
    nan, inf = float("nan"), float("inf")
    good = rows_of(3, 12)
    bad = [
        (100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [nan] + [1.0] * 63),
        (105, [1.0] * 63 + [inf]), (106, [-inf] * 64), (107, [None] + [1.0] * 63),
    ]
    assert result(spark, good + bad) == brute(good + bad)
    assert sum(result(spark, good + bad).values()) == 12


def test_null_keys_start_last(spark):
    rows = [(None, v) for _, v in rows_of(4, 10)] + rows_of(5, 4)
    assert result(spark, rows) == brute(rows)


def test_fewer_rows_than_clusters_and_none(spark):
    assert result(spark, rows_of(6, 3)) == brute(rows_of(6, 3))
    assert result(spark, []) == Counter()
    empty = CentroidClusters().classes(
        spark.createDataFrame([], "vec_id bigint, embedding array<double>")
    )
    full = CentroidClusters().classes(
        spark.createDataFrame(rows_of(6, 3), "vec_id bigint, embedding array<double>")
    )
    assert empty.schema.simpleString() == full.schema.simpleString()


def test_ties_fall_to_the_smaller_number(spark):
    rows = [(i, [float(i % 2)] + [0.0] * 63) for i in range(6)] + [(9, [0.5] + [0.0] * 63)]
    assert result(spark, rows) == brute(rows)


def test_whole_numbers_beyond_longs(spark):
    rows = rows_of(7, 20)
    rows += [(50, [1e300] + [0.0] * 63), (51, [-1e300] * 64), (52, [3e5] * 64), (53, [1e-320] * 64)]
    assert result(spark, rows, "double") == brute(rows)


def test_bounds_never_change_the_nearest(spark):
    rng = np.random.default_rng(8)
    ints = rng.integers(-3, 3, (500, 6))
    centres = rng.integers(-3, 3, (20, 6)).tolist()
    centres += centres[:5]
    for leading in (1, 3, 6):
        axes = np.linalg.qr(rng.standard_normal((6, 6)))[0][:, :leading]
        rotation = Rotation(ints.mean(axis=0), axes)
        compared = Centres(centres, rotation)
        which, least = compared.nearest(ints, *rotation.project(ints.astype(float)))
        assert list(zip(which.tolist(), least.tolist())) == [compared.exact(r) for r in ints.tolist()]
