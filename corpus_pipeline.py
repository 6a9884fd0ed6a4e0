"""From raw documents to token ids, in stages that each write what they keep.

Every stage works on all that its predecessor kept: the classifier's rejects go, of equal texts and
of near copies one document stays, the mixture takes what its weights and budget allow, once per
epoch, and every document that is left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyward.llm import bpe, exact, jaccard, quality
from tallyward.llm.queries import MIXTURE, WORD_BPE
from tallyward.sources.scratch import Scratch

# Near copies share at least 0.8 of their five-word shingles; op2's own contract is another.
NEAR_COPIES = jaccard.JaccardJoin(words=5, percent=80)

# The classifier's fit and the encoding have no SQL; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.CoTraining().scored(docs, labels).filter("kept").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.first_of_each(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs, NEAR_COPIES)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return MIXTURE.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, WORD_BPE)


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again before the next.

    Null and empty texts have no shingles and no tokens: the classifier judges them as texts, one of
    them stays, and they are encoded to nothing. Rows that repeat a key or text are one text to the
    dedup stages. Ties fall to the smaller key, then to what sorts first. Very long texts are worked
    on whole. Columns beyond those of ``documents`` go through all stages but the last, which returns
    doc_id, n_tokens, ids_sha256 and decoded_sha256. An empty table gives an empty result.
    """
    scratch = Scratch.create(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{n}")
        if n:
            scratch.remove(f"stage-{n - 1}")
    return docs
