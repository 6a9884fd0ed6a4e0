from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from tallyward.llm import phrases
from tallyward.llm.arrow import PIECE
from tallyward.llm.phrases import PhraseIndex, Segment, contaminated, item_windows, row_terms
from tallyward.sources.scratch import Scratch

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id bigint, text string, segment int, item string, words string, group int, doc int"


def words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return WORD.findall(low)


def brute(docs, items, length=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), length)
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    found = []
    for key, text in docs:
        w, hit, ids = words(text), set(), set()
        for i in range(len(w)):
            for n in range(1, length + 1):
                if i + n <= len(w) and tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    ids |= {str(x) for x in windows[tuple(w[i : i + n])] if x is not None}
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        found.append((key, len(w), len(hit), len(ids), sha, bool(hit)))
    return Counter(found)


def result(spark, docs, items, **options):
    d = spark.createDataFrame([(*r, 1, "x", "y", 2, 3) for r in docs], SCHEMA).repartition(3)
    b = spark.createDataFrame(
        [(*r, 1, "y") for r in items], "item_id bigint, text string, segment int, key string"
    )
    return Counter(tuple(r) for r in contaminated(d, b, **options).collect())


def corpus(seed=1, n=60, vocabulary=12):
    rng = random.Random(seed)
    some = [rng.choice(["a", "Bé", "C3", "ß", "x", "the", "ΣΑ"]) + str(i) for i in range(vocabulary)]
    text = lambda k: "".join(rng.choice(some) + rng.choice([" ", "-", "\n", "... "]) for _ in range(k))
    items = [(i, text(rng.randrange(1, 16))) for i in range(20)]
    docs = []
    for i in range(n):
        body = text(rng.randrange(0, 40))
        if i % 3 == 0:
            body += rng.choice(items)[1].upper() + text(rng.randrange(0, 9))
        docs.append((i, body))
    return docs, items


def test_equals_brute_force(spark):
    docs, items = corpus()
    got = result(spark, docs, items)
    assert got == brute(docs, items)
    assert sum(n for row, n in got.items() if row[5]) > 20


def test_short_windows_and_common_words(spark):
    docs, items = corpus(2, vocabulary=2)
    items = [(i, t) for i, t in items if len(words(t)) > 3]
    assert result(spark, docs, items, length=4) == brute(docs, items, 4)


def test_odd_rows(spark):
    docs = [
        (1, None), (2, ""), (3, " .,-\t"), (4, "One two THREE"), (4, "One two THREE"),
        (4, "one two"), (None, "one-two.three four"), (6, "two three"), (7, "É é"), (8, "é"),
    ]
    items = [
        (10, "one two three"), (10, "one two three"), (9, "two three"), (None, "four"),
        (5, None), (6, ""), (7, "!?"), (8, "É"), (100, "one two three"),
    ]
    assert result(spark, docs, items) == brute(docs, items)
    assert result(spark, docs, []) == brute(docs, [])
    assert result(spark, [], items) == Counter()


def test_very_long_text_and_word(spark):
    filler = " ".join(f"w{i % 977}" for i in range(120_000))
    passage = "this passage of the benchmark stands in a very long text"
    docs = [(1, filler + " " + passage + " " + filler), (2, "x" * (2 * PIECE) + " " + passage), (3, passage)]
    items = [(1, passage), (2, "w1 w2 w3 w4")]
    assert result(spark, docs, items) == brute(docs, items)


def test_hot_passage(spark):
    passage = "one very common passage that a third of all the documents hold today"
    docs = [(i, f"start {i} {passage} end" if i % 3 else f"nothing {i}") for i in range(600)]
    items = [(i, f"{passage} item {i}") for i in range(40)]
    assert result(spark, docs, items) == brute(docs, items)


def test_chunks_of_windows_give_the_same(spark, monkeypatch):
    docs, items = corpus(3)
    monkeypatch.setattr(phrases, "CHUNK", 7)
    assert result(spark, docs, items) == brute(docs, items)


def test_slices_of_starts_give_the_same(monkeypatch):
    docs, items = corpus(4, n=30, vocabulary=3)
    counts, terms = row_terms(pa.array([t for _, t in docs]))
    place = [p + doc for doc, c in enumerate(counts) for p in range(sum(counts[:doc]), sum(counts[: doc + 1]))]
    segment = Segment(*Segment.pack(terms, np.array(place)))
    _, wanted = row_terms(pa.array([t for _, t in items]))
    windows = phrases.Windows.of([wanted[i : i + 3].tolist() for i in range(0, len(wanted) - 3)], [0] * (len(wanted) - 3))
    at_once = sorted(zip(*(x.tolist() for x in segment.phrases(windows))))
    monkeypatch.setattr(phrases, "STARTS", 5)
    assert at_once and sorted(zip(*(x.tolist() for x in segment.phrases(windows)))) == at_once


def test_words_are_cut_nowhere(monkeypatch):
    monkeypatch.setattr(phrases, "PIECE", 16)
    texts = [t for _, t in corpus(5)[0]] + ["é" * 40, None, "", "a b", "x" * 17 + " y"]
    counts, terms = row_terms(pa.array(texts))
    whole = [w for t in texts for w in words(t)]
    assert counts.tolist() == [len(words(t)) for t in texts]
    names = {}
    assert all(names.setdefault(h, w) == w for h, w in zip(terms.tolist(), whole))
    assert len(set(whole)) == len(set(terms.tolist()))


def near_brute(text, phrase, within):
    w, wanted = words(text), set(words(phrase))
    spans = [
        (i, j)
        for i in range(len(w))
        for j in range(i + 1, min(i + within, len(w)) + 1)
        if wanted <= set(w[i:j])
    ]
    return {
        s for s in spans if not any(t != s and s[0] <= t[0] and t[1] <= s[1] for t in spans)
    }


def test_proximity_equals_brute_force(spark):
    docs, _ = corpus(6)
    asked = [(1, "a1 x0"), (2, docs[0][1][:12]), (3, docs[3][1][:30]), (4, "absent"), (5, docs[5][1][:3])]
    scratch = Scratch.create(spark)
    index = PhraseIndex.build(spark.createDataFrame(docs, "doc_id bigint, text string"), scratch)
    items = spark.createDataFrame(asked, "item_id bigint, text string")
    got = index.near(
        item_windows(items, 1000).withColumnRenamed("item", "phrase"), 9, scratch
    ).collect()
    want = {
        (phrase, key, i, j)
        for phrase, p in asked
        for key, text in docs
        for i, j in near_brute(text, p, 9)
        if words(p)
    }
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 10
