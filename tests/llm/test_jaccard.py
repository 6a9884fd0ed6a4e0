from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallyward.llm import shingles
from tallyward.llm.jaccard import JaccardJoin, one_of_each


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def sets_of(rows, size=4):
    out = []
    for _, text in rows:
        w = words_of(text)
        if len(w) >= size:
            out.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)})
        else:
            out.append({tuple(w)} if w else set())
    return out


def brute(rows):
    sets = sets_of(rows)
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                label[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return Counter((key, len(sets[i]), least.get(root(i))) for i, (key, _) in enumerate(rows))


def edited(seed, n=150):
    """Chains of copies with a few changed words, copies of copies, shared lines, odd texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcÀé") for _ in range(rng.randint(1, 4))) for _ in range(300)]
    line = " ".join(rng.choices(vocabulary, k=25))
    rows = []
    for i in range(n):
        kind = rng.randint(0, 5)
        if kind <= 2 and rows:
            words = (rng.choice(rows)[1] or "").split(" ")
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            text = " ".join(words)
            if rng.random() < 0.2:
                text = text.upper().replace(" ", "\n\t")
        elif kind == 3:
            text = line + " " + " ".join(rng.choices(vocabulary, k=rng.randint(0, 10)))
        elif kind == 4:
            text = rng.choice([None, "", " \n", "one", "two words", "One", "a b c d"])
        else:
            text = " ".join(rng.choices(vocabulary, k=rng.randint(5, 120)))
        rows.append((i, text))
    rng.shuffle(rows)
    return rows


def result(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rows = edited(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert result(JaccardJoin().classes(df)) == brute(rows)


def test_links_at_the_threshold(spark):
    # 23 shingles each, 3 of them different: 20 of 26; then 22 of 24
    base = [f"w{i}" for i in range(26)]
    near, far = [*base], [*base]
    near[0], far[2] = "x", "x"
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert result(JaccardJoin().classes(df)) == brute(rows)


def test_odd_tables(spark):
    rows = [(None, "a b c d e"), (4, "a b c d e"), (4, "other"), (4, "other"), (5, None), (None, "")]
    df = spark.createDataFrame(
        [(k, t, 1, "n") for k, t in rows], "doc_id bigint, text string, n int, node string"
    )
    assert result(JaccardJoin().classes(df)) == brute(rows)
    assert JaccardJoin().classes(df.limit(0)).count() == 0
    kept = one_of_each(df).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [
        (0, ""),
        (4, "a b c d e"),
        (4, "other"),
        (5, ""),
    ]


def test_sets_of_long_and_cut_texts(monkeypatch):
    rows = edited(9, 60)
    rows.append((0, " ".join(t or "" for _, t in rows)))
    rows.append((1, "x" * 900 + " y z " + "v" * 800))
    want = [len(s) for s in sets_of(rows)]
    column = pa.array([t for _, t in rows])
    whole = list(shingles.shingle_sets(column, 4))
    assert [len(s) for s in whole] == want
    monkeypatch.setattr(shingles, "PIECE", 256)
    cut = list(shingles.shingle_sets(column, 4))
    assert all(np.array_equal(a, b) for a, b in zip(whole, cut))


def test_bits_never_rule_out_a_link():
    from tallyward.llm.jaccard import differing, odd_bits

    rng = np.random.default_rng(2)
    for _ in range(300):
        items = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 300)).astype(np.uint64))
        cut = rng.random(len(items)) < rng.random()
        other = np.unique(np.append(items[cut], rng.integers(0, 1 << 63, rng.integers(1, 300)).astype(np.uint64)))
        assert differing(odd_bits(items), odd_bits(other)) <= len(np.setxor1d(items, other))
        assert differing(odd_bits(items), odd_bits(items)) == 0


def test_bitmap_loses_no_wanted_row(spark):
    from pyspark.sql import functions as F

    from tallyward.llm.bitmap import maybe_wanted

    rows = spark.range(20000).select("id", F.xxhash64("id").alias("key"))
    wanted = rows.filter("id % 97 = 0").select("key")
    found = {r.id for r in maybe_wanted(rows, "key", wanted).collect()}
    assert found >= set(range(0, 20000, 97)) and len(found) < 300
    assert maybe_wanted(rows, "key", wanted.limit(0)).count() == 0


def test_repeated_rows_of_one_key_are_limited_early(spark):
    rows = [(1, "a b c d e")] * 50 + [(None, "f g h i j")] * 50 + [(2, " \n"), (2, " \n"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = one_of_each(df)
    assert "WindowGroupLimit" in kept._jdf.queryExecution().optimizedPlan().toString()
    assert Counter(map(tuple, kept.collect())) == Counter([(1, "a b c d e"), (None, "f g h i j"), *rows[-3:]])
