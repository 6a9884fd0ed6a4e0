"""Removal of long repeated byte strings with a logarithmic family of sparse suffix arrays.

**Sampled suffixes.** Every window of ``length`` bytes names one anchor: the position in it whose
``anchor`` bytes have the smallest fingerprint, the leftmost on ties. Equal windows name anchors at
equal offsets, so a repeated window is found from its anchor alone, and a text needs one suffix per
about ``(length - anchor) / 2`` bytes. The windows that name the same anchor are a run; the stretch
of text that they cover is the anchor's context. A suffix is ordered by fingerprints of its bytes
from the anchor on (``sym``) and of its context (``full``).

**Index family.** A new batch gets its suffix array: its distinct (sym, full) with counts, sorted. It
is merge-scanned against the arrays of all levels; suffixes that share ``sym`` with another are the
candidates of a long match, on both sides. The array then joins the family as level 0, and two levels
of equal size merge into one of twice the size, so a suffix is rewritten O(log batches) times.

**Extension.** Candidates with an equal context repeat in all their windows. Where contexts of one
``sym`` differ, a match begins or ends there, and the windows are told apart in two steps: cells of
`CELL` windows, decided by what all windows of the cell share and by what they cover together, and
then the windows of the cells that stay open. All of this is counting of fingerprints with map-side
combining: linear in the candidates, with no pairs, whatever the size of a group.

Fingerprints of 64 bits stand for bytes within one ``sym``; a wrong match needs two of them to
collide. Texts longer than `PIECE` are cut at fixed places with an overlap of one window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm.arrow import (
    INVERSE,
    PIECE,
    mixed,
    pieces,
    powers,
    prefix_sums,
    text_bytes,
)
from tallyward.llm.bitmap import key_test, maybe_wanted
from tallyward.sources.scratch import Scratch

CELL = 32
POSITION_BITS = 21


def fingerprints(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit fingerprint of the ``width`` bytes from each position on."""
    total = prefix_sums(data)
    rolled = total[width:] - total[: len(total) - width]
    rolled *= powers(INVERSE, len(rolled))
    return mixed(rolled)


def window_anchors(data: np.ndarray, length: int, anchor: int) -> np.ndarray:
    """The anchor of the window that starts at each position."""
    span = length - anchor + 1
    mark = fingerprints(data, anchor)
    low = np.uint64((1 << POSITION_BITS) - 1)
    mark = (mark & ~low) | np.arange(len(mark), dtype=np.uint64)
    windows = len(mark) - span + 1
    rows = -(-len(mark) // span)
    padded = np.full(rows * span, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(mark)] = mark
    grid = padded.reshape(rows, span)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    lowest = np.minimum(right[:windows], left[span - 1 : span - 1 + windows])
    return (lowest & low).astype(np.int64)


def suffixes(
    data: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int, anchor: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, first window, last window, anchor) of each run of windows with one anchor.

    ``begin`` and ``end`` are the texts' places in ``data``; no window crosses them.
    """
    base = int(begin[0])
    begin, end = begin - base, end - base
    fits = np.flatnonzero(end - begin >= length)
    if not len(fits):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    data = data[base : base + int(end[-1])]
    anchors = window_anchors(data, length, anchor)
    counts = end[fits] - begin[fits] - length + 1
    firsts = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(fits)), counts)
    start = np.arange(counts.sum()) - firsts[text] + begin[fits][text]
    at = anchors[start]
    new = np.ones(len(start), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return fits[text[first]], start[first] + base, start[last] + base, at[first] + base


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _merged(lo: list[int], hi: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of windows, joined where they touch; lo ascending."""
    at = None
    for a, b in zip(lo, hi):
        if at is not None and a <= at[1] + 1:
            at = at[0], max(at[1], b)
            continue
        if at is not None:
            yield at
        at = a, b
    if at is not None:
        yield at


KEY = ("id", "thash")


@dataclass
class SuffixFamily:
    """Levels of sorted suffix arrays over the batches added so far.

    ``length`` is the shortest repeat that counts, ``anchor`` the bytes of an anchor. Longer anchors
    make more suffixes and fewer candidates that are no match.
    """

    spark: SparkSession
    scratch: Scratch
    length: int = 400
    anchor: int = 160
    levels: dict[int, DataFrame] = field(default_factory=dict)
    batches: int = 0
    postings: list[DataFrame] = field(default_factory=list)
    found: list[DataFrame] = field(default_factory=list)

    def add(self, docs: DataFrame) -> None:
        """Index a batch (id, thash, text) and note the candidates it has with all levels."""
        n, self.batches = self.batches, self.batches + 1
        posted = self.scratch.keep(self.sampled(docs), f"postings-{n}")
        self.postings.append(posted)
        new = self.scratch.keep(
            posted.filter("sym IS NOT NULL")
            .groupBy("sym", "full")
            .agg(F.sum("n").alias("n"))
            .sortWithinPartitions("sym", "full"),
            f"array-{n}",
        )
        self.found.append(self.scratch.keep(self.scan(new), f"found-{n}"))
        size = 1
        while size in self.levels:
            old = self.levels.pop(size)
            size *= 2
            merged = (
                old.unionByName(new)
                .groupBy("sym", "full")
                .agg(F.sum("n").alias("n"))
                .sortWithinPartitions("sym", "full")
            )
            new = self.scratch.keep(merged, f"level-{size}-{n}")
        self.levels[size] = new

    def scan(self, new: DataFrame) -> DataFrame:
        """``sym`` of the new suffixes that occur again, in the batch or on a level."""
        both = new.select("sym", "n", F.lit(True).alias("new"))
        for level in self.levels.values():
            both = both.unionByName(level.select("sym", "n", F.lit(False).alias("new")))
        return (
            both.groupBy("sym")
            .agg(F.sum("n").alias("n"), F.max("new").alias("new"))
            .filter("new AND n > 1")
            .select("sym")
        )

    def sampled(self, docs: DataFrame) -> DataFrame:
        """The sampled suffixes of each text, (id, thash, sym, full, p, lo, hi, n).

        A context that a text holds several times repeats for certain: it is listed once with
        ``n = 2``, and its windows come as merged runs without ``sym``.
        """
        length, anchor = self.length, self.anchor
        kind = docs.schema["id"].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, offsets = text_bytes(batch.column(2))
                view = memoryview(data)
                for rows, begin, end in pieces(offsets, PIECE, length - 1):
                    text, lo, hi, p = suffixes(data, begin, end, length, anchor)
                    if not len(text):
                        continue
                    digest = xxhash.xxh64_intdigest
                    sym = [digest(view[a : a + anchor]) for a in p.tolist()]
                    full = [
                        digest(view[a : b + length], c - a)
                        for a, b, c in zip(lo.tolist(), hi.tolist(), p.tolist())
                    ]
                    yield _posted(batch, rows[text], offsets, sym, full, p, lo, hi)

        return docs.select(*KEY, "text").mapInArrow(
            run,
            f"id {kind}, thash bigint, sym bigint, full bigint, p bigint, lo bigint, hi bigint, "
            "n int",
        )

    def candidates(self) -> DataFrame:
        """Postings whose ``sym`` occurs more than once, and the runs that repeat for certain."""
        posted = _union(self.postings)
        found = _union(self.found).distinct()
        return posted.filter("sym IS NOT NULL").join(found, "sym", "left_semi").unionByName(
            posted.filter("sym IS NULL")
        )


def _posted(batch, row, offsets, sym, full, p, lo, hi) -> pa.RecordBatch:
    """Rows of `SuffixFamily.sampled` for one piece, with places counted from the text's start."""
    place: dict[tuple[int, int, int], int] = {}
    take: list[int] = []
    again: dict[int, list[int]] = {}
    count: list[int] = []
    for i, key in enumerate(zip(row.tolist(), sym, full)):
        j = place.get(key)
        if j is None:
            place[key] = len(take)
            take.append(i)
            count.append(1)
        else:
            if count[j] == 1:
                again.setdefault(key[0], []).append(take[j])
                count[j] = 2
            again.setdefault(key[0], []).append(i)
    base = offsets[row]
    lo, hi, p = lo - base, hi - base, p - base
    runs = [
        (r, a, b)
        for r, found in again.items()
        for a, b in _merged(lo[np.sort(found)].tolist(), hi[np.sort(found)].tolist())
    ]
    none = [None] * len(runs)
    rows = np.concatenate([row[take], np.array([r for r, _, _ in runs], np.int64)])
    chosen = batch.select([0, 1]).take(pa.array(rows.astype(np.int64)))

    def longs(values: np.ndarray, more: list) -> pa.Array:
        return pa.concat_arrays([pa.array(values, pa.int64()), pa.array(more, pa.int64())])

    return pa.RecordBatch.from_arrays(
        [
            chosen.column(0),
            chosen.column(1),
            longs(_signed(sym)[take], none),
            longs(_signed(full)[take], none),
            longs(p[take], none),
            longs(lo[take], [a for _, a, _ in runs]),
            longs(hi[take], [b for _, _, b in runs]),
            pa.array([*count, *([0] * len(runs))], pa.int32()),
        ],
        ["id", "thash", "sym", "full", "p", "lo", "hi", "n"],
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    found = frames[0]
    for frame in frames[1:]:
        found = found.unionByName(frame)
    return found


def _same_text(docs: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """Join on id (null equals null) and text hash; keeps the columns of ``docs`` and the others'."""
    other = other.withColumnRenamed("id", "id_").withColumnRenamed("thash", "thash_")
    on = docs["id"].eqNullSafe(other["id_"]) & (docs["thash"] == other["thash_"])
    return docs.join(other, on, how).drop("id_", "thash_")


def repeated_windows(docs: DataFrame, family: SuffixFamily, scratch: Scratch) -> DataFrame:
    """(id, thash, lo, hi): runs of window starts that occur elsewhere too."""
    length, anchor = family.length, family.anchor
    cand = scratch.keep(family.candidates(), "candidates")
    certain = cand.filter("sym IS NULL OR n > 1").select(*KEY, "lo", "hi")
    # one row per context: how often it occurs, and where for the first time
    contexts = scratch.keep(
        cand.filter("sym IS NOT NULL")
        .groupBy("sym", "full")
        .agg(F.sum("n").alias("n"), F.min(F.struct(*KEY, "p", "lo", "hi")).alias("one")),
        "contexts",
    )
    whole = contexts.filter("n > 1").select("sym", "full")
    equal = (
        cand.filter("n = 1").join(whole, ["sym", "full"], "left_semi").select(*KEY, "lo", "hi")
    )
    # stored, so that the join below has a plain side that can be split where a sym is hot
    mixed = scratch.keep(
        contexts.groupBy("sym").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "mixed"
    )
    edges = scratch.keep(
        contexts.join(mixed, "sym", "left_semi")
        .groupBy("one.id", "one.thash")
        .agg(F.collect_list(F.struct("sym", "one.p", "one.lo", "one.hi")).alias("edges")),
        "edges",
    )
    held = maybe_wanted(docs.select(*KEY, "text"), "thash", edges.select("thash"))
    kind = docs.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for i, found in enumerate(batch.column(3)):
                edges = found.as_py()
                text = data[offsets[i] : offsets[i + 1]].tobytes()
                at = batch.select([0, 1]).take(pa.array([i] * len(edges), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [at.column(0), at.column(1)]
                    + [pa.array([e[c] for e in edges], pa.int64()) for c in ("sym", "p", "lo", "hi")]
                    + [pa.array([text[e["lo"] : e["hi"] + length] for e in edges], pa.binary())],
                    ["id", "thash", "sym", "p", "lo", "hi", "context"],
                )

    stretches = scratch.keep(
        _same_text(held, edges, "inner").mapInArrow(
            cut,
            f"id {kind}, thash bigint, sym bigint, p bigint, lo bigint, hi bigint, context binary",
        ),
        "stretches",
    )

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            row, cell, core, cover, near, far = [], [], [], [], [], []
            for i, (p, lo, hi, text) in enumerate(
                zip(*(batch.column(c).to_pylist() for c in (3, 4, 5, 6)))
            ):
                # a window's distance is from its start to the anchor
                least, most = p - hi, p - lo
                for k in range(least // CELL, most // CELL + 1):
                    a, b = max(least, k * CELL), min(most, k * CELL + CELL - 1)
                    row.append(i)
                    cell.append(k)
                    begin = p - k * CELL - lo
                    core.append(digest(text[begin : begin - CELL + 1 + length]))
                    cover.append(digest(text[p - b - lo : p - a - lo + length], a * length + b))
                    near.append(a)
                    far.append(b)
            at = batch.select([0, 1, 2, 3]).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(at.column(c) for c in range(4)), pa.array(cell, pa.int64())]
                + [pa.array(_signed(x), pa.int64()) for x in (core, cover)]
                + [pa.array(near, pa.int64()), pa.array(far, pa.int64())],
                ["id", "thash", "sym", "p", "cell", "core", "cover", "near", "far"],
            )

    celled = scratch.keep(
        stretches.mapInArrow(
            cells,
            f"id {kind}, thash bigint, sym bigint, p bigint, cell bigint, core bigint, "
            "cover bigint, near bigint, far bigint",
        ),
        "cells",
    )
    covers = scratch.keep(
        celled.groupBy("sym", "cell", "core", "cover").agg(
            F.count("*").alias("n"), F.min(F.struct(*KEY, "p", "near", "far")).alias("one")
        ),
        "covers",
    )
    in_cell = (
        celled.join(
            covers.filter("n > 1").select("sym", "cell", "core", "cover"),
            ["sym", "cell", "core", "cover"],
            "left_semi",
        ).select(*KEY, (F.col("p") - F.col("far")).alias("lo"), (F.col("p") - F.col("near")).alias("hi"))
    )
    open_cells = (
        covers.groupBy("sym", "cell", "core").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    )
    opened = (
        covers.join(open_cells, ["sym", "cell", "core"], "left_semi")
        .select("sym", "one.*")
        .groupBy(*KEY, "sym", "p")
        .agg(F.collect_list(F.struct("near", "far")).alias("open"))
        .withColumnsRenamed({"id": "id_", "thash": "thash_", "sym": "sym_", "p": "p_"})
    )

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            row, start, found = [], [], []
            for i, (p, lo, text, cells) in enumerate(
                zip(*(batch.column(c).to_pylist() for c in (3, 4, 5, 6)))
            ):
                for cell in cells:
                    for d in range(cell["near"], cell["far"] + 1):
                        row.append(i)
                        start.append(p - d)
                        found.append(digest(text[p - d - lo : p - d - lo + length], d))
            at = batch.select([0, 1, 2]).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(at.column(c) for c in range(3)), pa.array(start, pa.int64())]
                + [pa.array(_signed(found), pa.int64())],
                ["id", "thash", "sym", "start", "window"],
            )

    on = (
        stretches["id"].eqNullSafe(opened["id_"])
        & (stretches["thash"] == opened["thash_"])
        & (stretches["sym"] == opened["sym_"])
        & (stretches["p"] == opened["p_"])
    )
    each = scratch.keep(
        stretches.join(opened, on)
        .select(*KEY, "sym", "p", "lo", "context", "open")
        .mapInArrow(
            windows, f"id {kind}, thash bigint, sym bigint, start bigint, window bigint"
        ),
        "windows",
    )
    again = each.groupBy("sym", "window").agg(F.count("*").alias("n")).filter("n > 1")
    alone = each.join(again, ["sym", "window"], "left_semi").select(
        *KEY, F.col("start").alias("lo"), F.col("start").alias("hi")
    )
    return scratch.finish(_union([certain, equal, in_cell, alone]))


def without_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = 400,
    anchor: int = 160,
    batches: int = 4,
    texts: bool = False,
) -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans, kept_sha256, spans and, if asked, kept (binary).

    Removed is each byte covered by a string of ``length`` bytes that also starts anywhere else, in
    another row or the same; ``spans`` lists the maximal removed runs as [begin, end) in bytes. A
    null text is empty and loses nothing, as do texts shorter than ``length``. Rows equal in key and
    text are two texts, so long ones repeat each other; rows with one key and different texts are
    told apart by a hash of the text. Other columns are not read. What is kept may cut a character
    in two, so it is binary.
    """
    spark, scratch = docs.sparkSession, Scratch.create(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(
        F.col(key).alias("id"), F.xxhash64(text).alias("thash"), F.col(text).alias("text")
    )
    family = SuffixFamily(spark, scratch, length, anchor)
    batch = F.pmod(F.xxhash64("id", "thash"), F.lit(batches))
    for n in range(batches):
        family.add(rows.filter(batch == n))
    runs = repeated_windows(rows, family, scratch)
    per_text = runs.groupBy(*KEY).agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            data, offsets = text_bytes(one.column(1))
            total, removed, spans, shas, kept = [], [], [], [], []
            for i, found in enumerate(one.column(2)):
                whole = data[offsets[i] : offsets[i + 1]]
                runs = sorted((r["lo"], r["hi"] + length) for r in found.as_py() or ())
                # spans that touch are one run
                out = [(a, b + 1) for a, b in _merged([a for a, _ in runs], [b - 1 for _, b in runs])]
                left, at = [], 0
                for a, b in out:
                    left.append(whole[at:a])
                    at = b
                left.append(whole[at:])
                left_bytes = np.concatenate(left).tobytes()
                total.append(len(whole))
                removed.append(len(whole) - len(left_bytes))
                spans.append([list(s) for s in out])
                shas.append(hashlib.sha256(left_bytes).hexdigest())
                kept.append(left_bytes if texts else None)
            arrays = [
                one.column(0),
                pa.array(total, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array([len(s) for s in spans], pa.int64()),
                pa.array(shas, pa.string()),
                pa.array(spans, pa.list_(pa.list_(pa.int64()))),
            ]
            names = ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
            if texts:
                arrays.append(pa.array(kept, pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = f"key {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
    schema += "spans array<array<bigint>>" + ", kept binary" * texts
    # texts without a run need no shuffle
    wanted = key_test(runs.select("thash").distinct(), "thash")
    some, others = rows.filter(wanted("thash")), rows.filter(~wanted("thash"))
    joined = (
        _same_text(some, per_text, "left")
        .select("id", "text", "runs")
        .unionByName(
            others.select("id", "text", F.lit(None).cast(per_text.schema["runs"].dataType).alias("runs"))
        )
    )
    return joined.mapInArrow(cut, schema).withColumnRenamed("key", key)
