from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tallyward.llm import alignment
from tallyward.llm.alignment import Alignment, lockstep, text_parts
from tallyward.llm.bpe import byte_symbols
from tallyward.llm.queries import BYTE_BPE, PIECES
from tallyward.llm.vocabularies import vocabulary_file
from tallyward.sources.scratch import Scratch


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(vocabulary_file(BYTE_BPE))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=vocabulary_file(PIECES))


def brute(libraries, docs):
    """One document after the other, one token after the other."""
    a_library, b_library = libraries
    value = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
    measured, counts = [], Counter()
    for key, text in docs:
        empty = key, 0, 0, [], ""
        if not text:
            measured.append(empty)
            continue
        a = a_library.encode(" " + text, add_special_tokens=False).ids
        b = b_library.encode(text)
        a_bytes = [bytes(value[x] for x in a_library.id_to_token(i)) for i in a]
        names = [b_library.id_to_piece(i) for i in b]
        b_bytes = [
            bytes([int(n[3:5], 16)]) if b_library.is_byte(i) else n.replace("▁", " ").encode()
            for i, n in zip(b, names)
        ]
        whole = (" " + text).encode()
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            measured.append(empty)
            continue
        a_ends = dict(zip(np.cumsum([len(x) for x in a_bytes]).tolist(), range(len(a))))
        b_ends = dict(zip(np.cumsum([len(x) for x in b_bytes]).tolist(), range(len(b))))
        links, groups, i, j = [], [], 0, 0
        for cut in sorted(a_ends.keys() & b_ends.keys()):
            p, q = a_ends[cut] + 1, b_ends[cut] + 1
            links.append((a[p - 1], b[q - 1]))
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            i, j = p, q
        counts.update(links)
        measured.append((key, len(a), len(b), links, ";".join(groups)))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return Counter(
        (
            key, n_a, n_b, len(links), len(links), sum(counts[x] == most[x[1]] for x in links),
            sum(counts[x] for x in links), hashlib.sha256(shown.encode()).hexdigest() if links else "",
        )
        for key, n_a, n_b, links, shown in measured
    )


def result(spark, docs, parts=3):
    df = spark.createDataFrame(
        [(*d, 1, "x", 2, "y") for d in docs],
        "doc_id bigint, text string, row int, key string, a int, pair string",
    )
    return Counter(tuple(r) for r in Alignment(BYTE_BPE, PIECES).aligned(df.repartition(parts)).collect())


def texts(seed=1, n=60):
    rng = random.Random(seed)
    some = ["the", "Tokenization", "naïve", "漢字", "🙂", "12345", "don't", "\n\n", "  ", "x=y;", "über", "<s>", "</s>"]
    return [(i, " ".join(rng.choice(some) for _ in range(rng.randrange(1, 60)))) for i in range(n)]


def test_equals_brute_force(spark, libraries):
    docs = texts()
    got = result(spark, docs)
    assert got == brute(libraries, docs)
    assert sum(r[1] > 0 for r in got) > 40


def test_given_documents(spark, libraries, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = Counter(tuple(r) for r in Alignment(BYTE_BPE, PIECES).aligned(docs).collect())
    assert got == brute(libraries, [tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_odd_rows(spark, libraries):
    docs = [
        (1, None), (2, ""), (3, " "), (4, "▁ not given back"), (5, "same"), (5, "same"), (5, "other"),
        (None, "null key"), (6, "<|endoftext|>"), (7, "\x00\x01"), (8, "é" * 300), (9, "a  b "), (10, "ﬁ ½"),
    ]
    assert result(spark, docs) == brute(libraries, docs)
    assert result(spark, []) == Counter()


def test_very_long_texts(spark, libraries):
    long = " ".join(t for _, t in texts(2, 2500))
    docs = [(1, long), (2, "short text"), (3, "y" * 70_000), (4, long + " ▁")]
    assert len(text_parts(long)) > 2
    assert result(spark, docs, 2) == brute(libraries, docs)


def test_parts_units_and_lanes_change_nothing(libraries, monkeypatch):
    docs = [t for _, t in texts(3, 30)] + ["plain words only " * 20, None, "▁"]

    def figures():
        used = alignment.Encoders(BYTE_BPE, PIECES)
        return [
            (f.sha.hexdigest(), f.n_a, f.n_b, f.n_links, sorted(np.concatenate(f.pairs).tolist()) if f.pairs else [])
            for f in alignment._measured(docs, used)
        ]

    whole = figures()
    for name, value in (("LANE", 3), ("UNIT", 50), ("PART", 20), ("STRETCHES", 5)):
        monkeypatch.setattr(alignment, name, value)
        assert figures() == whole


def test_stretches_give_the_ids_of_whole_texts(libraries):
    used = alignment.Encoders(BYTE_BPE, PIECES)
    rng = random.Random(7)
    odd = [" ", "  ", "\n", "\t", "\x1c", "\u00a0", "\u3000", "\u200b", "a", "the", "'s", "é", "e\u0301", "漢", "7", "🙂", "▁", "."]
    made = ["".join(rng.choice(odd) for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    for text, found in zip(made, used.parts(made)):
        a, b = libraries[0].encode(" " + text, add_special_tokens=False).ids, libraries[1].encode(text)
        if found.spelled:
            assert np.frombuffer(found.a, np.int32).tolist() == a, repr(text)
            assert np.frombuffer(found.b, np.int32).tolist() == b, repr(text)
        assert found.spelled == used.spelled(a, b, b" " + text.encode())


def test_joined_counts_equal_broadcast_counts(spark, libraries, monkeypatch):
    docs = texts(4) + [(99, "the same words")] * 40
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", 0)
    assert result(spark, docs) == brute(libraries, docs)


def test_counts_are_of_all_documents(spark):
    docs = spark.createDataFrame(texts(5), "doc_id bigint, text string")
    scratch = Scratch.create(spark)
    aligner = Alignment(BYTE_BPE, PIECES)
    measured = scratch.keep(aligner.measured(docs), "m")
    counts = aligner.counts(measured, scratch).collect()
    assert sum(r["count"] for r in counts) == sum(r["n_links"] for r in measured.collect())
    assert {r["b"] for r in counts if r["best"]} == {r["b"] for r in counts}


def test_lockstep_on_any_ends():
    rng = np.random.default_rng(6)
    for _ in range(50):
        sizes = rng.integers(1, 40, rng.integers(1, 8))
        end = np.cumsum(sizes)
        begin = end - sizes
        a, b = (
            np.unique(np.append(end, rng.integers(1, end[-1] + 1, rng.integers(0, 60)))) for _ in "ab"
        )
        at_a, at_b = lockstep(a, b, begin, end)
        both = np.intersect1d(a, b)
        assert a[at_a].tolist() == b[at_b].tolist() == both.tolist()
