from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest

from tallyward.llm.exact import RadixDedup, first_of_each


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault(normal(text), []).append(key)
    out = []
    for key, text in rows:
        known = [k for k in groups[normal(text)] if k is not None]
        keep = min(known) if known else None
        sha = hashlib.sha256(normal(text).encode()).hexdigest()
        out.append((key, keep, len(groups[normal(text)]), key == keep, sha))
    return Counter(out)


def result(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("first, growth", [(1, 2), (3, 4), (256, 16)])
def test_equals_brute_force(spark, first, growth):
    rng = random.Random(first)
    texts = ["".join(rng.choice("ab \n\té") for _ in range(rng.randint(0, 9))) for _ in range(80)]
    texts += [t + "x" * n for t in texts[:5] for n in (700, 701, 5000)] * 2 + [None, "", " ", "\t "]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert result(RadixDedup(first_block=first, growth=growth).groups(df)) == brute(rows)


def test_repeated_and_null_keys(spark):
    long = "y" * 300
    rows = [(1, long), (1, long + "a"), (1, long + "a"), (None, long + "b"), (None, long + "b"), (None, "z")]
    rows += [(2, long), (2, long + "a"), (None, long)]
    df = spark.createDataFrame(
        [(k, t, "x", 0) for k, t in rows], "doc_id bigint, text string, keep_id string, kept int"
    )
    assert result(RadixDedup().groups(df)) == brute(rows)
    assert RadixDedup().groups(df.limit(0)).count() == 0
    kept = [(r.doc_id, r.text) for r in first_of_each(df).collect()]
    assert Counter(kept) == Counter([(1, long), (1, long + "a"), (None, long + "b"), (None, "z")])


def test_groups_of_one_key_are_numbered_apart(spark):
    rows = [(None, f"{i:03d}" + "x" * 300 + end) for i in range(100) for end in "ab"]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    first = df.selectExpr(
        "doc_id AS id", "CAST(NULL AS bigint) AS grp", "0L AS salt", "0 AS nth", "CAST(text AS binary) AS rest"
    )
    split = RadixDedup()._split(first, 256, True)
    assert split.select("grp", "salt", "nth").distinct().count() == 100
    assert split.groupBy("grp", "salt").agg({"nth": "max"}).filter("`max(nth)` = 1").count() == 100
    assert result(RadixDedup().groups(df)) == brute(rows)
