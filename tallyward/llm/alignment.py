"""Alignment of two tokenizers' tokens by lockstep merging of their byte ends.

Both tokenizations of a text cover the same bytes. A position where a token of A and a token of B end
is a cut; between cuts lie the groups, and the two tokens that end at a cut are linked.

**Lockstep merge.** The ends of all documents of a batch lie on one axis of bytes. The axis is cut
into lanes, stretches of at most `LANE` bytes of one document: an end belongs to the lane it falls
in, so lanes need nothing of each other and a long document is many of them. One state vector holds
the two pointers of all lanes. A step compares the ends under the pointers of every lane at once,
emits a link and a cut where they are equal, moves on whichever end is not beyond the other, and
drops the lanes that are done.

**Encoding.** Neither vocabulary's tokens reach over a single space between letters. A worker keeps
the ids of the stretches between such spaces that it has met, in a cache of bounded size.

**Counts.** How often a pair of ids is linked in all documents needs one pass over all of them. The
first pass stores each document's figures and its distinct pairs; the pairs are counted with map-side
combining, and a second pass over the stored pairs adds up the counts of each document. The counts
are one row per pair of ids, broadcast only while they are few, joined by shuffle beyond.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.bpe import byte_symbols
from tallyward.llm.generations import Generations
from tallyward.llm.vocabularies import vocabulary_file
from tallyward.sources.scratch import Scratch

LANE = 512  # bytes
UNIT = 1 << 20  # bytes of text that are merged at once
PART = 1 << 16  # letters that are encoded at once
BROADCAST_PAIRS = 1 << 20  # some 40 MB as a hash table
STRETCHES = 100_000  # in a generation of the cache
CACHED_LETTERS = 64
# A single space between letters of any kind. Both vocabularies start a new word at it, whatever
# surrounds it: no token reaches across, so the stretches on both sides are encoded by themselves.
BORDER = re.compile(r" (?=\S)(?<=\S )")


@dataclass
class Vocabulary:
    """Bytes of every token id, and their number."""

    tokens: list[bytes]
    lengths: np.ndarray = field(init=False)

    def __post_init__(self):
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)

    def spells(self, ids: list[int], text: bytes) -> bool:
        return b"".join(map(self.tokens.__getitem__, ids)) == text


class Encoded(NamedTuple):
    """Ids of a stretch or part as packed 32-bit numbers, and whether their bytes are its own."""

    a: bytes
    b: bytes
    spelled: bool


class Encoders:
    """A byte-level vocabulary (A) and a piece vocabulary that puts a space in front (B)."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has its own tasks
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(vocabulary_file(byte_level))
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=vocabulary_file(pieces))
        value = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        entries = {i: t for t, i in self.a.get_vocab().items()}
        self.a_tokens = Vocabulary(
            [bytes(value[x] for x in entries.get(i, "")) for i in range(max(entries) + 1)]
        )
        size = self.b.get_piece_size()
        names = [self.b.id_to_piece(i) for i in range(size)]
        self.b_tokens = Vocabulary(
            [
                bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace("▁", " ").encode()
                for i, n in enumerate(names)
            ]
        )

        self.cache: Generations[Encoded] = Generations(STRETCHES, CACHED_LETTERS)

    def spelled(self, a: list[int], b: list[int], text: bytes) -> bool:
        return self.a_tokens.spells(a, text) and self.b_tokens.spells(b, text)

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """Ids by A of a space and the text, and by B of the text."""
        found = self.a.encode_batch_fast([" " + text], add_special_tokens=False)
        return found[0].ids, self.b.encode(text)

    def alone(self, stretch: str) -> Encoded:
        a, b = self.encode(stretch)
        spelled = self.spelled(a, b, b" " + stretch.encode())
        return Encoded(np.array(a, np.int32).tobytes(), np.array(b, np.int32).tobytes(), spelled)

    def learn(self, stretches: list[str]) -> dict[str, Encoded]:
        """Ids of new stretches; those with a letter at either end are encoded as one text."""
        found, held, size = {}, [], 0
        for stretch in stretches:
            if not stretch or stretch[0].isspace() or stretch[-1].isspace():
                found[stretch] = self.alone(stretch)
                continue
            held.append(stretch)
            size += len(stretch)
            if size > PART:
                found.update(self._together(held))
                held, size = [], 0
        return found | (self._together(held) if held else {})

    def _together(self, stretches: list[str]) -> dict[str, Encoded]:
        text = " ".join(stretches)
        a, b = self.encode(text)
        if not self.spelled(a, b, b" " + text.encode()):
            return {s: self.alone(s) for s in stretches}
        end = np.cumsum([len(s.encode()) + 1 for s in stretches])
        cuts = []
        for ids, known in ((a, self.a_tokens), (b, self.b_tokens)):
            packed = np.array(ids, np.int32)
            upto = 4 * (np.searchsorted(np.cumsum(known.lengths[packed]), end) + 1)
            packed, begin = packed.tobytes(), 0
            cut = []
            for stop in upto.tolist():
                cut.append(packed[begin:stop])
                begin = stop
            cuts.append(cut)
        return {s: Encoded(x, y, True) for s, x, y in zip(stretches, *cuts)}

    def parts(self, texts: list[str]) -> list[Encoded]:
        """Each text's packed ids, and whether both give back a space and the text."""
        split = [BORDER.split(t) for t in texts]
        known = self.cache.having(chain.from_iterable(split), self.learn)
        found = []
        for text, stretches in zip(texts, split):
            each = list(map(known.__getitem__, stretches))
            a, b = (b"".join([e[k] for e in each]) for k in (0, 1))
            good = all([e[2] for e in each]) or self.spelled(
                np.frombuffer(a, np.int32).tolist(), np.frombuffer(b, np.int32).tolist(), b" " + text.encode()
            )
            found.append(Encoded(a, b, good))
        return found


@lru_cache(maxsize=2)
def encoders(byte_level: str, pieces: str) -> Encoders:
    """The encoders of two files, one per Python worker."""
    return Encoders(byte_level, pieces)


def text_parts(text: str) -> list[str]:
    """A text in parts of about `PART` letters, without the single spaces between them."""
    parts, begin = [], 0
    while len(text) - begin > PART and (at := BORDER.search(text, begin + PART)):
        parts.append(text[begin : at.start()])
        begin = at.end()
    parts.append(text[begin:])
    return parts


def lockstep(
    a_end: np.ndarray, b_end: np.ndarray, begin: np.ndarray, end: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(token of A, token of B) of every pair of tokens that end at one byte, in order.

    ``a_end`` and ``b_end`` are ascending places on one axis, on which the documents are the
    stretches from ``begin`` to ``end``.
    """
    count = -(-(end - begin) // LANE)
    lane = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    low = np.repeat(begin, count) + lane * LANE
    high = np.minimum(low + LANE, np.repeat(end, count))
    state = np.stack(
        [
            np.searchsorted(ends, edge, "right")
            for edge in (low, high)
            for ends in (a_end, b_end)
        ]
    )
    links = []
    while True:
        live = (state[0] < state[2]) & (state[1] < state[3])
        if not live.all():
            state = state[:, live]
        if not state.shape[1]:
            break
        a, b = a_end[state[0]], b_end[state[1]]
        met = a == b
        links.append(state[:2, met])
        state[0] += a <= b
        state[1] += b <= a
    if not links:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = np.concatenate(links, axis=1)
    return tuple(found[:, np.argsort(found[0])])


@dataclass
class Unit:
    """Ids of some parts on end, with the number of each part's tokens and bytes."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    size: np.ndarray

    def merged(self, encoders: Encoders) -> tuple[np.ndarray, np.ndarray]:
        self.link_a, self.link_b = lockstep(
            np.cumsum(encoders.a_tokens.lengths[self.a]),
            np.cumsum(encoders.b_tokens.lengths[self.b]),
            np.cumsum(self.size) - self.size,
            np.cumsum(self.size),
        )
        return self.link_a, self.link_b

    def shown(self) -> tuple[bytes, np.ndarray]:
        """The groups of all parts as text, and where each part's text ends."""
        group_a = np.searchsorted(self.link_a, np.arange(len(self.a)))
        group_b = np.searchsorted(self.link_b, np.arange(len(self.b)))
        before = np.append(0, self.link_b + 1)  # tokens of B before each group
        at_a = np.arange(len(self.a)) + before[group_a]
        at_b = np.arange(len(self.b)) + self.link_a[group_b] + 1
        ids = np.empty(len(self.a) + len(self.b), np.int64)
        ids[at_a], ids[at_b] = self.a, self.b
        mark = np.full(len(ids), ord(","), np.uint8)
        mark[at_a[self.link_a]] = ord("|")
        mark[at_b[self.link_b]] = ord(";")
        last = at_b[np.cumsum(self.n_b) - 1]
        width = len(str(int(ids.max())))
        table = np.empty((len(ids), width + 1), np.uint8)
        keep = np.ones((len(ids), width + 1), bool)
        rest = ids.copy()
        for column in range(width - 1, -1, -1):
            table[:, column] = rest % 10 + ord("0")
            if column < width - 1:
                keep[:, column] = rest > 0
            rest //= 10
        table[:, width] = mark
        keep[last, width] = False
        ends = np.cumsum(keep.sum(axis=1))[last]
        return table[keep].tobytes(), ends


@dataclass
class Figures:
    """What is known of one document; its parts come one after the other."""

    sha: object = field(default_factory=hashlib.sha256)
    n_a: int = 0
    n_b: int = 0
    n_links: int = 0
    pairs: list[np.ndarray] = field(default_factory=list)

    def add(self, shown: bytes, n_a: int, n_b: int, pairs: np.ndarray) -> None:
        if self.n_a:
            self.sha.update(b";")
        self.sha.update(shown)
        self.n_a += n_a
        self.n_b += n_b
        self.n_links += len(pairs)
        self.pairs.append(pairs)


def _measured(texts: list[str | None], encoders: Encoders) -> list[Figures]:
    """The figures of each text; those without tokens are as they start."""
    found = [Figures() for _ in texts]
    parts = [(i, part) for i, text in enumerate(texts) if text for part in text_parts(text)]
    if not parts:
        return found
    encoded = encoders.parts([p for _, p in parts])
    bad = {i for (i, _), e in zip(parts, encoded) if not e.spelled}
    size = [len(part.encode()) + 1 for _, part in parts]
    good = [n for n, (i, _) in enumerate(parts) if i not in bad]
    for low, high in _runs([size[n] for n in good], UNIT):
        mine = good[low:high]
        unit = Unit(
            *(
                np.frombuffer(b"".join([encoded[n][k] for n in mine]), np.int32).astype(np.int64)
                for k in (0, 1)
            ),
            *(np.array([len(encoded[n][k]) // 4 for n in mine]) for k in (0, 1)),
            np.array([size[n] for n in mine]),
        )
        link_a, link_b = unit.merged(encoders)
        pairs = (unit.a[link_a] << 32) | unit.b[link_b]
        # a part's last tokens are linked, so its links end there
        upto = np.searchsorted(link_a, np.cumsum(unit.n_a))
        shown, ends = unit.shown()
        first, begin = 0, 0
        counts = unit.n_a.tolist(), unit.n_b.tolist()
        for n, n_a, n_b, after, end in zip(mine, *counts, upto.tolist(), ends.tolist()):
            found[parts[n][0]].add(shown[begin:end], n_a, n_b, pairs[first:after])
            first, begin = after, end
    return found


def _runs(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges whose sizes come to ``most`` at the most, or of one."""
    low, total = 0, 0
    for i, size in enumerate(sizes):
        if i > low and total + size > most:
            yield low, i
            low, total = i, 0
        total += size
    if low < len(sizes):
        yield low, len(sizes)


@dataclass(frozen=True)
class Alignment:
    """Two vocabulary files, by path or by the name of a public one."""

    byte_level: str
    pieces: str
    key: str = "doc_id"
    text: str = "text"

    def measured(self, docs: DataFrame) -> DataFrame:
        """One row per document with its figures, a number, and its distinct pairs of linked ids."""
        files = self.byte_level, self.pieces
        kind = docs.schema[self.key].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = TaskContext.get().partitionId() << 33
            used = encoders(*files)
            for batch in batches:
                sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
                for low, high in _runs(sizes, UNIT):
                    part = batch.slice(low, high - low)
                    found = _measured(part.column(1).to_pylist(), used)
                    none = np.zeros(0, np.int64)
                    pairs = [
                        np.unique(np.concatenate(f.pairs or [none]), return_counts=True)
                        for f in found
                    ]
                    offsets = np.append(0, np.cumsum([len(p) for p, _ in pairs]))
                    flat = np.concatenate([p for p, _ in pairs])
                    times = np.concatenate([t for _, t in pairs])
                    lists = [
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x, pa.int32()))
                        for x in (flat >> 32, flat & 0xFFFFFFFF, times)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.arange(number, number + len(found)), pa.int64()), part.column(0)]
                        + [pa.array([getattr(f, n) for f in found], pa.int64()) for n in ("n_a", "n_b", "n_links")]
                        + [pa.array([f.sha.hexdigest() if f.n_a else "" for f in found]), *lists],
                        ["row", "key", "n_a", "n_b", "n_links", "groups_sha256", "a", "b", "times"],
                    )
                    number += len(found)

        return docs.select(self.key, self.text).mapInArrow(
            run,
            f"row bigint, key {kind}, n_a bigint, n_b bigint, n_links bigint, groups_sha256 string, "
            "a array<int>, b array<int>, times array<int>",
        )

    def links(self, measured: DataFrame) -> DataFrame:
        """(row, a, b, times): the distinct pairs of linked ids of each document."""
        return measured.select("row", F.inline(F.arrays_zip("a", "b", "times")))

    def counts(self, measured: DataFrame, scratch: Scratch) -> DataFrame:
        """(a, b, count, best): links of a pair in all documents, and whether no A has more for b."""
        counted = scratch.keep(
            self.links(measured).groupBy("a", "b").agg(F.sum("times").alias("count")), "counted"
        )
        most = counted.groupBy("b").agg(F.max("count").alias("most"))
        return scratch.keep(
            counted.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best")),
            "counts",
        )

    def aligned(self, docs: DataFrame) -> DataFrame:
        """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document.

        A null or empty text, and one that either vocabulary does not give back byte by byte after a
        space, has no tokens: zeros and an empty digest. Rows of equal keys or texts are documents of
        their own and all count. Very long texts are encoded and merged in parts. Without documents
        there are no rows. Other columns are not read.
        """
        scratch = Scratch.create(docs.sparkSession)
        measured = scratch.keep(self.measured(docs), "measured")
        counts = self.counts(measured, scratch)
        pair = F.shiftleft(F.col("a").cast("bigint"), 32).bitwiseOR(F.col("b")).alias("pair")
        known = counts.select(pair, "count", "best")
        if counts.count() <= BROADCAST_PAIRS:
            known = F.broadcast(known)
        sums = (
            self.links(measured)
            .select("row", pair, "times")
            .join(known, "pair")
            .groupBy("row")
            .agg(
                F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                F.sum(F.col("times") * F.col("count")).alias("count_sum"),
            )
        )
        zero = F.lit(0).cast("bigint")
        return scratch.finish(
            measured.select("row", "key", "n_a", "n_b", "n_links", "groups_sha256")
            .join(sums, "row", "left")
            .select(
                F.col("key").alias(self.key),
                "n_a",
                "n_b",
                F.col("n_links").alias("n_groups"),
                "n_links",
                F.coalesce("n_best", zero).alias("n_best"),
                F.coalesce("count_sum", zero).alias("count_sum"),
                "groups_sha256",
            )
        )
