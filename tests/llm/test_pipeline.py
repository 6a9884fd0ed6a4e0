from __future__ import annotations

import hashlib
from collections import Counter

import pytest

import corpus_pipeline
from tallyward.llm.quality import CoTraining
from tallyward.llm.queries import MIXTURE, WORD_BPE
from tallyward.llm.vocabularies import vocabulary_file
from tests.llm import test_exact, test_jaccard, test_mixing

tokenizers = pytest.importorskip("tokenizers")


def test_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = [
        (r.doc_id, r.text, r.lang, r.source)
        for r in CoTraining().scored(docs, labels).filter("kept").collect()
    ]
    firsts = {k[1] for k in test_exact.brute([r[:2] for r in kept])}
    kept = [r for r in kept if r[0] in firsts]
    least = {k[2] for k in test_jaccard.brute([r[:2] for r in kept])}
    kept = [r for r in kept if r[0] in least]
    number = lambda s: "".join(c for c in s if c.isdigit())
    times = test_mixing.brute(kept, MIXTURE, lambda s: f"d{int(number(s)) % 4}")
    library, texts = tokenizers.Tokenizer.from_file(vocabulary_file(WORD_BPE)), {r[0]: r[1] for r in kept}
    want = Counter()
    for (key, *_), n in times.items():
        ids = library.encode(texts[key], add_special_tokens=False).ids
        sha = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want[key, len(ids), sha] += n
    got = corpus_pipeline.run(spark, sf_dir)
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in got.collect()) == want


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns
        assert stage(spark, docs.limit(0), sf_dir).columns == docs.columns


def least_of_near(rows):
    """The keys that stay when texts with at least 0.8 of their five-word shingles in common link."""
    sets = test_jaccard.sets_of(rows, 5)
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                label[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (key, _) in enumerate(rows):
        least[root(i)] = min(key, least.get(root(i), key))
    return sorted(least.values())


def test_near_copies_link_from_four_fifths_of_five_words(spark):
    base = [f"w{i}" for i in range(100)]
    longer = base + [f"v{i}" for i in range(23)]  # 96 of 119 shingles; of four words 97 of 120
    longest = base + [f"u{i}" for i in range(25)]  # 96 of 121: no link
    changed = [f"s{i}" for i in range(229)]
    for i in range(20, 220, 40):
        changed[i] = f"t{i}"  # 5 words of 229: 200 of 250 shingles, the least that links
    rows = [(1000, " ".join(base)), (1001, " ".join(longer)), (1002, " ".join(longest))]
    rows += [(1003, " ".join(f"s{i}" for i in range(229))), (1004, " ".join(changed))]
    assert least_of_near(rows) == [1000, 1002, 1003]
    rows += test_jaccard.edited(4)
    docs = spark.createDataFrame(
        [(k, t, "en", "s") for k, t in rows], "doc_id bigint, text string, lang string, source string"
    )
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == least_of_near(rows)
