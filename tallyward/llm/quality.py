"""Quality classifier by co-training of two views.

The content view sees the words of a text, the metadata view what is known without reading it: its
source, its language, its length and the shape of its lines and characters. Each view has a naive
Bayes classifier over hashed features. In every round each classifier labels the unlabelled documents
that it is confident about, and these pseudo-labels join the training rows of the other view. At the
end both views' scores are calibrated and combined on labelled rows kept out of training, and every
document is scored.

At scale: features are extracted once and stored in a few hundred bytes a document. A round is one
pass over them that scores, draws pseudo-labels and counts features, all in the same task; what
leaves a task are counters of fixed size, as is what reaches the driver. Models are arrays of fixed
size. All labelled rows of the training folds train, and all unlabelled rows can be pseudo-labelled;
only calibration, a fit of five weights, takes a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh32_intdigest

from tallyward.llm.arrow import text_bytes
from tallyward.llm.shingles import SPACE, _long_text, _stretches, word_prints
from tallyward.sources.scratch import Scratch

CONTENT_BITS, META_BITS = 16, 12
WORDS = (1 << CONTENT_BITS) - 64  # the last features of the content view tell how words repeat
STRETCH = 4096
SHORT = 12

UPPER, DIGIT, OTHER, ALPHA = (np.zeros(256, bool) for _ in range(4))
UPPER[65:91] = True
DIGIT[48:58] = True
ALPHA[65:91] = ALPHA[97:123] = True
ALPHA[128:] = True
OTHER[:] = ~(ALPHA | DIGIT | SPACE)


def _steps(share: float, steps: int = 20) -> int:
    return min(int(share * steps + 0.5), steps)


def _hashed(name: str) -> int:
    return xxh32_intdigest(name) % (1 << META_BITS)


def content_features(words: np.ndarray) -> np.ndarray:
    """Hashed distinct words; then how much the commonest word, repeats and distinct words make up."""
    n = len(words)
    if not n:
        return np.array([WORDS], np.uint16)
    distinct, counts = np.unique(words, return_counts=True)
    hashed = np.unique(distinct % np.uint64(WORDS)).astype(np.uint16)
    if n < SHORT:  # shares of a handful of words tell nothing
        return np.append(hashed, np.uint16(WORDS))
    again = np.count_nonzero(words[1:] == words[:-1]) / n
    shares = (counts.max() / n, again, len(distinct) / n)
    shape = [WORDS + 1 + 21 * i + _steps(share) for i, share in enumerate(shares)]
    return np.append(hashed, np.array(shape, np.uint16))


def meta_features(data: np.ndarray, n_words: int, source: str | None, lang: str | None) -> np.ndarray:
    """Source, language, length and shape of the bytes, hashed."""
    n, n_words = len(data), max(n_words, 1)
    names = [f"source={source}", f"lang={lang}", f"size={int(np.log2(n + 1))}"]
    if n:
        bytes_ = np.bincount(data, minlength=256)
        symbols = np.where(OTHER, bytes_, 0)
        symbols[[44, 46]] = 0  # comma and full stop
        top = int(symbols.argmax())
        names += [
            f"line={int(np.log2(n / (bytes_[10] + 1) + 1))}",
            f"word={min(n // n_words, 40)}",
            f"upper={_steps(bytes_[UPPER].sum() / max(bytes_[ALPHA].sum(), 1))}",
            f"digit={_steps(bytes_[DIGIT].sum() / n, 40)}",
            f"symbols={_steps(symbols.sum() / n_words)}",
            f"symbol={top if symbols[top] else None}:{_steps(symbols[top] / n_words)}",
        ]
    return np.unique(np.array([_hashed(x) for x in names], np.uint16))


def features(
    batch: pa.RecordBatch, text: int, source: int, lang: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(content, metadata) features of each row of the batch."""
    data, offsets = text_bytes(batch.column(text))
    sources, langs = batch.column(source).to_pylist(), batch.column(lang).to_pylist()
    for a, b in _stretches(data, offsets):
        whole = data[offsets[a] : offsets[b]]
        if b == a + 1:
            words, before = (_long_text(whole) if len(whole) else np.zeros(0, np.uint64)), None
        elif not len(whole):
            words, before = np.zeros(0, np.uint64), np.zeros(b - a + 1, np.int64)
        else:
            words, before = word_prints(data, offsets[a:b], offsets[a + 1 : b + 1])
        for i in range(a, b):
            own = words if before is None else words[before[i - a] : before[i - a + 1]]
            yield (
                content_features(own),
                meta_features(data[offsets[i] : offsets[i + 1]], len(own), sources[i], langs[i]),
            )


@dataclass(frozen=True)
class View:
    """Naive Bayes over feature presence: log odds of class 1 for each feature."""

    odds: np.ndarray

    @classmethod
    def fit(cls, counts: np.ndarray, rows: np.ndarray) -> View:
        """``counts[c, f]``: rows of class c with feature f; ``rows[c]``: rows of class c."""
        rate = (counts + 0.5) / (rows[:, None] + 1.0)
        return cls(np.log(rate[1] / rate[0]))

    def sum(self, found: np.ndarray) -> float:
        return float(self.odds[found].sum())


def scores(views: tuple[View, View], found: tuple[np.ndarray, np.ndarray]) -> list[float]:
    """(words, their number, shape of the content, metadata) of one document.

    The words' odds overlap, so they count by the root of their number, and large sums less.
    """
    content, meta = found
    words = content[content < WORDS]
    return [
        float(np.arcsinh(views[0].sum(words) / np.sqrt(max(len(words), 1)))),
        float(np.log1p(len(words))),
        views[0].sum(content[content >= WORDS]),
        views[1].sum(meta),
    ]


# Which of the scores belong to the content and the metadata view.
CONTENT, META = [0, 1, 2], [3]


def probability(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Calibrated probability of class 1; the first weight is the constant."""
    return 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30)))


def logistic_fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic model, the constant first, by Newton steps with a small ridge."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, ridge = np.zeros(x.shape[1]), 0.1
    for _ in range(100):
        p = probability(x[:, 1:], w)
        gradient = x.T @ (y - p) - ridge * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass(frozen=True)
class CoTraining:
    """``rounds`` exchanges of pseudo-labels whose calibrated probability reaches ``sure``.

    Of the labelled rows, by a hash of the key, 7 of 10 train, 2 calibrate and 1 is held out for
    `accuracy`. Calibration takes at most ``sample`` of its rows, those first by a hash. A document
    is kept when its probability of quality is at least ``threshold``.
    """

    rounds: int = 3
    sure: float = 0.95
    sample: int = 20_000
    threshold: float = 0.3
    key: str = "doc_id"
    text: str = "text"

    def labelled(self, labels: DataFrame) -> DataFrame:
        """(key, label): one per document; null and contradictory labels count as none."""
        return (
            labels.filter(F.col(self.key).isNotNull() & F.col("quality").isin(0, 1))
            .groupBy(F.col(self.key).alias("key"))
            .agg(F.min("quality").alias("label"), F.max("quality").alias("high"))
            .filter("label = high")
            .select("key", F.col("label").cast("int").alias("label"))
        )

    def fold(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key), F.lit("fold")), F.lit(10)).cast("int")

    def extract(self, docs: DataFrame, labels: DataFrame) -> DataFrame:
        """(label, fold, content, meta) of each document; features as bytes of 16-bit numbers."""
        kind = docs.schema[self.key].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = list(features(batch, 1, 2, 3))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)]
                    + [pa.array([f[i].tobytes() for f in found], pa.binary()) for i in (0, 1)],
                    ["key", "content", "meta"],
                )

        bags = docs.select(self.key, self.text, "source", "lang").mapInArrow(
            run, f"key {kind}, content binary, meta binary"
        )
        # one plan at every size, so that what a small run shows holds for a large one
        return bags.join(self.labelled(labels).hint("merge"), "key", "left").select(
            "label", self.fold("key").alias("fold"), "content", "meta"
        )

    def counted(self, bags: DataFrame, models: tuple | None) -> tuple[tuple[np.ndarray, np.ndarray], ...]:
        """One pass: class counts by feature for each view, pseudo-labels of ``models`` included."""
        sure, sizes = self.sure, (1 << CONTENT_BITS, 1 << META_BITS)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals = [np.zeros((2, size + 1), np.int64) for size in sizes]
            for batch in batches:
                for label, fold, *bytes_ in zip(*(c.to_pylist() for c in batch.columns)):
                    if label is not None and fold >= 7:
                        continue  # kept out of training
                    found = [np.frombuffer(b, np.uint16) for b in bytes_]
                    taught: list[int | None] = [label, label]
                    if label is None:
                        if models is None:
                            continue
                        # what one view is sure of teaches the other
                        views, lines = models
                        x = np.array(scores(views, found))
                        for i, of in enumerate((CONTENT, META)):
                            p = probability(x[of], lines[i])
                            taught[1 - i] = 1 if p >= sure else 0 if p <= 1 - sure else None
                    for total, bag, c in zip(totals, found, taught):
                        if c is not None:
                            total[c, bag] += 1
                            total[c, -1] += 1
            for i, total in enumerate(totals):
                flat = total.ravel()
                places = range(0, len(flat), STRETCH)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i] * len(places), pa.int32()),
                        pa.array(places, pa.int32()),
                        pa.array([flat[p : p + STRETCH].tobytes() for p in places], pa.binary()),
                    ],
                    ["view", "part", "counts"],
                )

        found = []
        parts = _summed(
            bags.select("label", "fold", "content", "meta").mapInArrow(
                run, "view int, part int, counts binary"
            )
        )
        for i, size in enumerate(sizes):
            flat = np.zeros(2 * (size + 1), np.int64)
            for row in parts:
                if row["view"] == i:
                    part = np.frombuffer(row["counts"], np.int64)
                    flat[row["part"] : row["part"] + len(part)] = part
            total = flat.reshape(2, size + 1)
            found.append((total[:, :-1], total[:, -1]))
        return tuple(found)

    def calibration(self, bags: DataFrame, views: tuple[View, View]) -> tuple[np.ndarray, np.ndarray]:
        """(scores, labels) of the labelled rows kept for calibration, ``sample`` at most."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [
                    scores(views, tuple(np.frombuffer(b, np.uint16) for b in bags))
                    for bags in zip(*(batch.column(c).to_pylist() for c in (1, 2)))
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(found, pa.list_(pa.float64()))], ["label", "scores"]
                )

        rows = (
            bags.filter(F.col("label").isNotNull() & F.col("fold").isin(7, 8))
            .orderBy(F.xxhash64("content", "meta"))
            .limit(self.sample)
            .select("label", "content", "meta")
            .mapInArrow(run, "label int, scores array<double>")
            .collect()
        )
        x = np.array([r["scores"] for r in rows]).reshape(-1, len(CONTENT) + len(META))
        return x, np.array([r["label"] for r in rows], float)

    def fit(self, docs: DataFrame, labels: DataFrame) -> tuple[tuple[View, View], np.ndarray]:
        """(views, weights of the combined model)."""
        scratch = Scratch.create(docs.sparkSession)
        bags = scratch.keep(self.extract(docs, labels), "features")
        models = None
        for turn in range(self.rounds + 1):
            views = tuple(View.fit(*c) for c in self.counted(bags, models))
            x, y = self.calibration(bags, views)
            if turn < self.rounds:
                models = views, [logistic_fit(x[:, of], y) for of in (CONTENT, META)]
        scratch.remove()
        return views, logistic_fit(x, y)

    def scored(self, docs: DataFrame, labels: DataFrame) -> DataFrame:
        """``docs`` with s_content, s_meta (what each view adds to the log odds), p_quality and kept.

        Every row is scored by the models, labelled ones too. Null texts, sources and languages are
        values of their own. Without any usable label all probabilities are one half and all rows
        are kept. A label of a key that several rows share holds for all of them. An empty table
        gives an empty result; columns with the names of the scores are replaced. Texts are scored
        whole, however long, and rows that repeat one are scored alike.
        """
        views, weights = self.fit(docs, labels)
        added = ("s_content", "s_meta", "p_quality", "kept")
        docs = docs.drop(*added)
        names = docs.columns
        text, source, lang = (names.index(c) for c in (self.text, "source", "lang"))
        least = self.threshold

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.array(
                    [scores(views, found) for found in features(batch, text, source, lang)]
                ).reshape(-1, len(CONTENT) + len(META))
                p = probability(x, weights)
                content = weights[1 + np.array(CONTENT)] @ x[:, CONTENT].T
                meta = weights[1 + np.array(META)] @ x[:, META].T
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(content), pa.array(meta), pa.array(p), pa.array(p >= least)],
                    [*names, *added],
                )

        schema = T.StructType(list(docs.schema.fields))
        for name in added[:3]:
            schema.add(name, "double")
        return docs.mapInArrow(run, schema.add("kept", "boolean"))

    def accuracy(self, docs: DataFrame, labels: DataFrame) -> DataFrame:
        """(label, kept, rows) over the labelled documents held out of training and calibration."""
        held = self.labelled(labels).filter(self.fold("key") == 9)
        scored = self.scored(docs, labels).select(F.col(self.key).alias("key"), "kept")
        return scored.join(held, "key").groupBy("label", "kept").agg(F.count("*").alias("rows"))


def _summed(parts: DataFrame) -> list:
    """Counters added up by view and part: a number of rows that does not depend on the input."""

    def add(_: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.int64) for c in frame["counts"])
        return pd.DataFrame(
            {"view": frame["view"].iloc[:1], "part": frame["part"].iloc[:1], "counts": [total.tobytes()]}
        )

    return parts.groupBy("view", "part").applyInPandas(add, "view int, part int, counts binary").collect()
