from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tallyward.llm import suffix
from tallyward.llm.suffix import SuffixFamily, without_repeats


def brute(rows, length):
    """(id, n_bytes, n_removed, n_spans, kept_sha256) by counting every window."""
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (key, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i + 1 : i + length + 1] = True
        kept = bytes(b for b, g in zip(t, gone[1:]) if not g)
        starts = int(np.sum(gone[1:] & ~gone[:-1]))
        out.append((key, len(t), len(t) - len(kept), starts, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def copies(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    passages = [" ".join(word() for _ in range(rng.randint(5, 60))) for _ in range(6)]
    rows = []
    for i in range(n):
        kind = rng.randint(0, 6)
        if kind == 0 and rows:
            text = rng.choice(rows)[1]
        elif kind == 1 and rows:
            text = rng.choice(rows)[1] or ""
            at = rng.randint(0, len(text))
            text = text[:at] + word() + text[at:]
        elif kind == 2:
            text = (word() + " ") * rng.randint(1, 80)
        elif kind == 3:
            text = " ".join(rng.choice(passages) for _ in range(rng.randint(1, 4)))
        elif kind == 4:
            text = rng.choice([None, "", "a", "x" * rng.randint(1, 300)])
        else:
            parts = [" ".join(word() for _ in range(rng.randint(0, 40))) for _ in range(3)]
            text = parts[0] + rng.choice(passages) + parts[1] + rng.choice(passages) + parts[2]
        rows.append((i, text))
    return rows


def result(df):
    return Counter(
        tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    )


def test_windows_name_equal_anchors_wherever_they_stand():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 101, 5000).astype(np.uint8)
    data[3000:3400] = data[100:500]
    at = suffix.window_anchors(data, 60, 20)
    assert np.array_equal(at[100:441] - 100, at[3000:3341] - 3000)
    assert ((at >= np.arange(len(at))) & (at <= np.arange(len(at)) + 40)).all()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rows = copies(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = result(without_repeats(df, length=60, anchor=20, batches=1 + seed))
    assert got == brute(rows, 60)


def test_long_texts_are_cut_with_an_overlap(spark, monkeypatch):
    rows = copies(7, 12)
    rows.append((99, "".join(t or "" for _, t in rows) * 2))
    monkeypatch.setattr(suffix, "PIECE", 500)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    # tasks read the size from the module, so the cut is made here as well
    assert result(without_repeats(df, length=60, anchor=20)) == brute(rows, 60)
    offsets = np.array([0, 1700, 1750])
    parts = list(suffix.pieces(offsets, 500, 59))
    starts = [s for _, b, e in parts for x, y in zip(b, e) for s in range(x, y - 59)]
    assert starts == [*range(0, 1641)]


def test_odd_tables(spark):
    long = "".join(chr(97 + i % 7) + str(i) for i in range(200))
    rows = [(None, long), (1, long[:300]), (1, "other"), (1, "other"), (2, None), (3, "")]
    df = spark.createDataFrame(
        [(k, t, "x", 1) for k, t in rows], "doc_id bigint, text string, id string, n int"
    )
    assert result(without_repeats(df)) == brute(rows, 400)
    assert result(without_repeats(df, length=100, anchor=40)) == brute(rows, 100)
    assert without_repeats(df.limit(0)).count() == 0


def test_planted_passages_show_in_n_removed_and_not_in_n_bytes(spark):
    """Passages of over 50 words in two documents each: of 400 bytes or more they go, of 399 they stay."""
    rng = random.Random(9)

    def words(n):
        return " ".join("".join(rng.choices("abcdefghijklm", k=rng.randint(3, 7))) for _ in range(n))

    rows, planted = [], {}
    for size in (399, 400, 700):
        passage = words(size // 4)[:size]
        assert len(passage.split()) > 50
        for around in ("<>", "[]"):  # the bytes beside a passage differ, so it is no longer than it is
            planted[len(rows)] = size
            rows.append((len(rows), words(40) + around[0] + passage + around[1] + words(30)))
    rows += [(len(rows) + n, words(150)) for n in range(6)]
    got = without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert result(got) == brute(rows, 400)
    for r in got.collect():
        size = planted.get(r["doc_id"], 0)
        assert r["n_bytes"] == len(rows[r["doc_id"]][1])
        assert (r["n_removed"], r["n_spans"]) == ((size, 1) if size >= 400 else (0, 0))


def test_levels_merge_geometrically(spark):
    from tallyward.sources.scratch import Scratch

    scratch = Scratch.create(spark)
    family = SuffixFamily(spark, scratch, 60, 20)
    docs = spark.createDataFrame(copies(4), "id bigint, text string").selectExpr(
        "id", "xxhash64(text) AS thash", "text"
    )
    seen = []
    for n in range(5):
        family.add(docs.filter(f"id % 5 = {n}"))
        seen.append(sorted(family.levels))
    assert seen == [[1], [2], [1, 2], [4], [1, 4]]
