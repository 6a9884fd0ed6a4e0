"""Benchmark decontamination with a distributed positional inverted index.

**Index.** Documents are gathered into segments of about `SEGMENT` bytes of text, a longer document
is a segment of its own. A segment is one stored row: its documents, the sorted fingerprints of its
distinct terms, and for each term the list of its positions, as differences whose bytes lie plane by
plane so that they compress. Positions count the words of the segment; one position stays free
between two documents, so consecutive positions never cross documents. Segments are built where the
documents are read: the index needs no shuffle and no task sees more than a segment.

**Phrases.** Test windows come in chunks of bounded size, each broadcast once and met by every
segment. Within a segment a window whose terms are not all there is out at once. For the others the
list of the rarest term names the possible starts, and the lists of the next rarer terms, each moved
by the term's offset in the window, are intersected with them one after the other.

**Proximity.** All terms of a phrase within a stretch of so many words of one document, in any order:
the rarest list again names the places, and the latest position of every other term bounds the
stretch.

A window's items are kept as one group per distinct set of items, known by fingerprints, so a hit
names a group, and only groups are expanded into items. Terms are compared by 64-bit fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.arrow import INVERSE, PIECE, mixed, powers, prefix_sums, text_bytes
from tallyward.sources.scratch import Scratch

SEGMENT = 1 << 22  # bytes of text
CHUNK = 1 << 18  # windows that are broadcast at once, about 100 bytes each
STARTS = 1 << 20  # possible starts that are held at once
SEGMENT_SCHEMA = (
    "segment bigint, keys array<{kind}>, words array<int>, first array<int>, terms array<bigint>, "
    "ends array<int>, places binary"
)


def letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes with A-Z lowered, whether each belongs to a word)."""
    upper = (data >= 0x41) & (data <= 0x5A)
    low = data + (upper * np.uint8(0x20))
    digit = (low >= 0x30) & (low <= 0x39)
    return low, digit | ((low >= 0x61) & (low <= 0x7A)) | (low >= 0x80)


def stretches(inside: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(first row, row after the last, begin, end) of about `PIECE` bytes that cut no word.

    Whole rows are taken together while they fit; parts of a longer row have that row alone.
    """
    row, rows = 0, len(offsets) - 1
    while row < rows:
        begin, end = int(offsets[row]), int(offsets[row + 1])
        if end - begin > PIECE:
            gaps = np.flatnonzero(~inside[begin:end]) + begin
            while begin < end:
                at = int(np.searchsorted(gaps, begin + PIECE))
                stop = int(gaps[at]) + 1 if at < len(gaps) else end
                yield row, row + 1, begin, stop
                begin = stop
            row += 1
            continue
        last = int(np.searchsorted(offsets, begin + PIECE, "right")) - 1
        yield row, last, begin, int(offsets[last])
        row = last


def row_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(number of words of each row, fingerprints of all words in order) of a column of texts."""
    data, offsets = text_bytes(column)
    low, inside = letters(data)
    counts = np.zeros(len(offsets) - 1, np.int64)
    found = []
    for first, after, begin, end in stretches(inside, offsets):
        part = inside[begin:end]
        if not len(part):
            continue
        border = np.zeros(len(part) + 1, bool)
        border[offsets[first : after + 1].clip(begin, end) - begin] = True
        start = part.copy()
        start[1:] &= ~part[:-1] | border[1:-1]
        stop = part.copy()
        stop[:-1] &= ~part[1:] | border[1:-1]
        start, stop = np.flatnonzero(start), np.flatnonzero(stop) + 1
        if not len(start):
            continue
        total = prefix_sums(low[begin:end])
        value = (total[stop] - total[start]) * powers(INVERSE, len(part) + 1)[start]
        value += (stop - start).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        found.append(mixed(value).view(np.int64))
        counts += np.bincount(
            np.searchsorted(offsets, start + begin, "right") - 1, minlength=len(counts)
        )
    return counts, np.concatenate(found) if found else np.zeros(0, np.int64)


class Segment:
    """The postings of one stored row."""

    def __init__(self, terms: np.ndarray, ends: np.ndarray, places: bytes):
        self.terms = terms
        self.ends = ends
        planes = np.frombuffer(places, np.uint8).reshape(4, -1)
        steps = np.ascontiguousarray(planes.T).view(np.int32).ravel().astype(np.int64)
        # a step into the next term's list leads from position 0 of one term to that of the next
        self.begin = np.append(0, ends[:-1]) if len(ends) else ends
        counts = np.diff(np.append(0, ends))
        total = np.cumsum(steps)
        base = np.append(0, total)[self.begin]
        self.place = total - np.repeat(base, counts)
        # sorted, since lists are by term and each list is ascending
        self.postings = (np.repeat(np.arange(len(terms)), counts) << 32) | self.place

    @staticmethod
    def pack(terms: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes]:
        """(distinct terms, ends of their lists, places) of words given in ascending place."""
        order = np.argsort(terms, kind="stable")
        terms, place = terms[order], place[order]
        new = np.ones(len(terms), bool)
        new[1:] = terms[1:] != terms[:-1]
        first = np.flatnonzero(new)
        steps = np.diff(place, prepend=0)
        steps[first] = place[first]
        planes = np.ascontiguousarray(steps.astype(np.int32)).view(np.uint8).reshape(-1, 4).T
        ends = np.append(first[1:], len(terms)) if len(terms) else first
        return terms[first], ends, np.ascontiguousarray(planes).tobytes()

    def lookup(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, length of the list) of each term; length 0 where it is not there."""
        if not len(self.terms):
            return np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64)
        at = np.searchsorted(self.terms, terms).clip(max=len(self.terms) - 1)
        size = self.ends[at] - self.begin[at]
        return at, np.where(self.terms[at] == terms, size, 0)

    def has(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether each term stands at each place."""
        wanted = (term << 32) | place
        at = np.searchsorted(self.postings, wanted).clip(max=len(self.postings) - 1)
        return self.postings[at] == wanted

    def list_of(self, index: int) -> np.ndarray:
        return self.place[self.begin[index] : self.ends[index]]

    def phrases(self, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of every place where all words of a window stand in order."""
        index, size = self.lookup(windows.terms)
        pad = windows.words < 0
        there = np.flatnonzero(((size[windows.words] > 0) | pad).all(axis=1))
        if not len(there) or not len(self.place):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        words, pad = windows.words[there], pad[there]
        counts = np.where(pad, np.iinfo(np.int64).max, size[words])
        order = np.argsort(counts, axis=1, kind="stable")
        rarest = np.take_along_axis(counts, order[:, :1], axis=1).ravel()
        upto = np.cumsum(rarest)
        found = []
        for low, high in _slices(upto, STARTS):
            rows = np.arange(low, high)
            which = np.repeat(rows, rarest[rows])
            nth = np.arange(len(which)) - np.repeat(upto[rows] - rarest[rows] - (upto[low] - rarest[low]), rarest[rows])
            offset = order[which, 0]
            start = self.place[self.begin[index[words[which, offset]]] + nth] - offset
            keep = start >= 0
            which, start = which[keep], start[keep]
            for k in range(1, words.shape[1]):
                offset = order[which, k]
                term = words[which, offset]
                keep = (term < 0) | self.has(index[term], start + offset)
                which, start = which[keep], start[keep]
                if not len(which):
                    break
            found.append((there[which], start))
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def near(self, terms: np.ndarray, within: int, first: np.ndarray) -> list[tuple[int, int]]:
        """[begin, end) of the shortest stretches that hold all terms, of at most ``within`` places.

        ``first`` are the first places of the documents; a stretch lies in one of them. A stretch
        that holds another one is left out.
        """
        index, size = self.lookup(np.unique(terms))
        if not len(size) or not size.all():
            return []
        lists = [self.list_of(i) for i in index[np.argsort(size, kind="stable")]]
        rarest = lists[0]
        # a stretch ends at one of the terms, at most this far behind the rarest
        ends = [rarest]
        for places in lists[1:]:
            before = np.searchsorted(rarest, places, "right") - 1
            ends.append(places[(before >= 0) & (places - rarest[before.clip(0)] < within)])
        end = np.unique(np.concatenate(ends))
        begin = end.copy()
        for places in lists:
            at = np.searchsorted(places, end, "right") - 1
            begin = np.where(at >= 0, np.minimum(begin, places[at.clip(0)]), -within - 1)
        same = np.searchsorted(first, begin, "right") == np.searchsorted(first, end, "right")
        keep = (begin >= 0) & (end - begin < within) & same
        begin, end = begin[keep], end[keep]
        # of stretches with one begin the first to end is the shortest
        short = np.ones(len(begin), bool)
        short[1:] = begin[1:] != begin[:-1]
        return list(zip(begin[short].tolist(), (end[short] + 1).tolist()))


def _slices(upto: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose counts, given as running totals, come to about ``most``."""
    low = 0
    while low < len(upto):
        before = upto[low - 1] if low else 0
        high = max(int(np.searchsorted(upto, before + most, "right")), low + 1)
        yield low, high
        low = high


@dataclass(frozen=True)
class Windows:
    """A chunk of test windows: distinct terms, each window's words as their places (none: -1)."""

    terms: np.ndarray
    words: np.ndarray
    size: np.ndarray
    group: np.ndarray

    @classmethod
    def of(cls, words: list[list[int]], group: list[int]) -> Windows:
        size = np.array([len(w) for w in words], np.int64)
        flat = np.array([x for w in words for x in w], np.int64)
        terms, place = np.unique(flat, return_inverse=True)
        table = np.full((len(words), int(size.max(initial=1))), -1, np.int64)
        row = np.repeat(np.arange(len(words)), size)
        table[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = place
        return cls(terms, table, size, np.array(group, np.int64))


@dataclass(frozen=True)
class PhraseIndex:
    """Segments of postings over a table of documents, as a stored frame."""

    segments: DataFrame

    @classmethod
    def build(
        cls, docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text"
    ) -> PhraseIndex:
        """Index every row. Null and empty texts are documents without words."""
        kind = docs.schema[key].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = TaskContext.get().partitionId() << 33
            keys, counts, terms, size = [], [], [], 0
            for batch in batches:
                lengths = np.diff(text_bytes(batch.column(1))[1])
                upto = np.cumsum(lengths)
                for low, high in _slices(upto, SEGMENT):
                    more = int(lengths[low:high].sum())
                    if keys and size + more > SEGMENT:
                        yield _segment(number, keys, counts, terms)
                        number, keys, counts, terms, size = number + 1, [], [], [], 0
                    part = batch.slice(low, high - low)
                    count, found = row_terms(part.column(1))
                    keys.append(part.column(0))
                    counts.append(count)
                    terms.append(found)
                    size += more
            if keys:
                yield _segment(number, keys, counts, terms)

        rows = docs.select(key, text).mapInArrow(run, SEGMENT_SCHEMA.format(kind=kind))
        return cls(scratch.keep(rows, "segments"))

    def documents(self) -> DataFrame:
        """(segment, doc, key, n_words): every indexed row, doc is its place in the segment."""
        each = F.posexplode(F.arrays_zip("keys", "words")).alias("doc", "one")
        return self.segments.select("segment", each).select(
            "segment", "doc", F.col("one.keys").alias("key"), F.col("one.words").alias("n_words")
        )

    def exact(self, windows: DataFrame, scratch: Scratch) -> DataFrame:
        """(segment, doc, runs, groups) of documents that hold windows (words, group).

        ``runs`` are the covered places [begin, end), ``groups`` the groups of the windows found; a
        document comes once per chunk of windows that has some of them.
        """
        spark = self.segments.sparkSession
        chunks = max(-(-windows.count() // CHUNK), 1)
        found = []
        for n in range(chunks):
            chunk = windows.filter(F.pmod(F.xxhash64("words"), F.lit(chunks)) == n)
            held = chunk.select("words", "group").collect()  # about CHUNK rows
            if not held:
                continue
            shared = spark.sparkContext.broadcast(
                Windows.of([r["words"] for r in held], [r["group"] for r in held])
            )

            def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
                for segment, first, postings in _segments(batches):
                    yield _hits(segment, first, *postings.phrases(shared.value), shared.value)

            hits = self.segments.select("segment", "first", "terms", "ends", "places").mapInArrow(
                run,
                "segment bigint, doc int, runs array<struct<begin: int, end: int>>, "
                "groups array<bigint>",
            )
            found.append(scratch.keep(hits, f"hits-{n}"))
            shared.unpersist()
        if not found:
            return spark.createDataFrame(
                [],
                "segment bigint, doc int, runs array<struct<begin: int, end: int>>, "
                "groups array<bigint>",
            )
        hits = found[0]
        for more in found[1:]:
            hits = hits.unionByName(more)
        return hits

    def near(self, phrases: DataFrame, within: int, scratch: Scratch) -> DataFrame:
        """(phrase, key, begin, end): stretches of words that hold all terms of (words, phrase).

        Places count the words of the document. Phrases come in chunks, as windows do.
        """
        spark = self.segments.sparkSession
        kind = self.segments.schema["keys"].dataType.elementType.simpleString()
        chunks = max(-(-phrases.count() // CHUNK), 1)
        frames = []
        for n in range(chunks):
            chunk = phrases.filter(F.pmod(F.xxhash64("words"), F.lit(chunks)) == n)
            held = chunk.select("words", "phrase").collect()  # about CHUNK rows
            shared = spark.sparkContext.broadcast(
                [(np.array(r["words"], np.int64), r["phrase"]) for r in held if r["words"]]
            )

            def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
                for segment, first, postings in _segments(batches):
                    rows = []
                    for terms, phrase in shared.value:
                        for begin, end in postings.near(terms, within, first):
                            doc = int(np.searchsorted(first, begin, "right")) - 1
                            rows.append((phrase, doc, begin - first[doc], end - first[doc]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([segment] * len(rows), pa.int64())]
                        + [
                            pa.array([r[k] for r in rows], t)
                            for k, t in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.int32()))
                        ],
                        ["segment", "phrase", "doc", "begin", "end"],
                    )

            found = self.segments.select("segment", "first", "terms", "ends", "places").mapInArrow(
                run, "segment bigint, phrase bigint, doc int, begin int, end int"
            )
            frames.append(scratch.keep(found, f"near-{n}"))
        hits = frames[0]
        for more in frames[1:]:
            hits = hits.unionByName(more)
        docs = self.documents().select("segment", "doc", F.col("key").cast(kind).alias("key"))
        return hits.join(docs, ["segment", "doc"]).select("phrase", "key", "begin", "end")


def _segment(number: int, keys: list, counts: list, terms: list) -> pa.RecordBatch:
    """One stored row; documents are one place apart."""
    count = np.concatenate(counts)
    first = np.cumsum(count + 1) - count - 1
    words = np.concatenate(terms)
    place = np.arange(len(words)) + np.repeat(np.arange(len(count)), count)
    distinct, ends, places = Segment.pack(words, place)

    def one(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            one(pa.concat_arrays(keys)),
            one(pa.array(count, pa.int32())),
            one(pa.array(first, pa.int32())),
            one(pa.array(distinct, pa.int64())),
            one(pa.array(ends, pa.int32())),
            pa.array([places], pa.binary()),
        ],
        ["segment", "keys", "words", "first", "terms", "ends", "places"],
    )


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, Segment]]:
    """(segment, first places, postings) of rows (segment, first, terms, ends, places)."""
    for batch in batches:
        for i in range(batch.num_rows):
            lists = [
                batch.column(c)[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
                for c in (1, 2, 3)
            ]
            places = batch.column(4)[i].as_buffer()
            yield batch.column(0)[i].as_py(), lists[0], Segment(lists[1], lists[2], places)


def _lists(values: pa.Array, row: np.ndarray, rows: int) -> pa.Array:
    """Values whose rows are ascending, as one list per row."""
    offsets = np.append(0, np.cumsum(np.bincount(row, minlength=rows)))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _hits(
    segment: int, first: np.ndarray, window: np.ndarray, start: np.ndarray, windows: Windows
) -> pa.RecordBatch:
    """The covered runs and the groups of each document that holds windows."""
    order = np.argsort(start, kind="stable")
    window, start = window[order], start[order]
    upto = np.maximum.accumulate(start + windows.size[window]) if len(start) else start
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > upto[:-1]
    begin = start[new]
    end = upto[np.append(np.flatnonzero(new)[1:], len(start)) - 1] if len(start) else start
    doc = np.searchsorted(first, start, "right") - 1
    pairs = np.unique(np.stack([doc, windows.group[window]], axis=1), axis=0)
    docs, row = np.unique(pairs[:, 0], return_inverse=True)
    run = np.searchsorted(docs, np.searchsorted(first, begin, "right") - 1)
    runs = pa.StructArray.from_arrays(
        [pa.array(begin, pa.int32()), pa.array(end, pa.int32())], ["begin", "end"]
    )
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(docs), segment), pa.int64()),
            pa.array(docs, pa.int32()),
            _lists(runs, run, len(docs)),
            _lists(pa.array(pairs[:, 1], pa.int64()), row, len(docs)),
        ],
        ["segment", "doc", "runs", "groups"],
    )


def item_windows(items: DataFrame, length: int, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item, words): every ``length`` consecutive words of an item; a shorter item is one window."""
    kind = items.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, terms = row_terms(batch.column(1))
            size = np.minimum(counts, length)
            each = np.where(counts > 0, counts - size + 1, 0)
            row = np.repeat(np.arange(len(counts)), each)
            begin = (np.cumsum(counts) - counts)[row] + (
                np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
            )
            width = size[row]
            at = np.repeat(begin, width) + (
                np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)),
                    _lists(pa.array(terms[at], pa.int64()), np.repeat(np.arange(len(row)), width), len(row)),
                ],
                ["item", "words"],
            )

    return items.select(key, text).mapInArrow(run, f"item {kind}, words array<bigint>")


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    length: int = 10,
    key: str = "doc_id",
    item: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated) of every document.

    A word is a run of bytes other than ASCII marks and spaces, with A-Z lowered. Hit is each word
    inside an occurrence of a window, ``length`` consecutive words of an item or all words of a
    shorter one. ``n_items`` counts the distinct ids of items with an occurring window; items of a
    null id hit words and are not counted. Null, empty and wordless texts have no words and no hits,
    items without words have no windows, and without items nothing is hit. Rows of equal keys are
    documents of their own; equal texts are each judged. Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch.create(spark)
    index = PhraseIndex.build(docs, scratch, key, text)
    members = scratch.keep(item_windows(items, length, item, text).distinct(), "members")
    # windows of one set of items are one group
    print_of = F.sum(F.xxhash64("item").cast("decimal(38,0)")), F.bit_xor(F.xxhash64(F.lit(1), "item"))
    windows = scratch.keep(
        members.groupBy("words").agg(F.xxhash64(F.count("*"), *print_of).alias("group")), "windows"
    )
    shown = windows.groupBy("group").agg(F.min("words").alias("words"))
    groups = scratch.keep(
        members.join(shown, "words").select("group", F.col("item").cast("string").alias("item")),
        "groups",
    )
    hits = index.exact(windows, scratch)
    inside = F.expr(
        "aggregate(array_sort(flatten(collect_list(runs))), named_struct('n', 0L, 'upto', 0), "
        "(s, r) -> named_struct("
        "'n', s.n + greatest(r.end - greatest(r.begin, s.upto), 0), 'upto', greatest(s.upto, r.end))"
        ").n"
    )
    places = hits.groupBy("segment", "doc").agg(inside.alias("n_hit"))
    named = (
        hits.select("segment", "doc", F.explode("groups").alias("group"))
        .distinct()
        .join(groups, "group")
        .groupBy("segment", "doc")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    found = scratch.keep(places.join(named, ["segment", "doc"], "left"), "found")
    none = F.array().cast("array<string>")
    ids = F.coalesce("items", none)
    result = (
        index.documents()
        .join(found, ["segment", "doc"], "left")
        .select(
            F.col("key").alias(key),
            F.col("n_words").cast("bigint").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
            F.size(ids).cast("bigint").alias("n_items"),
            F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        )
    )
    return scratch.finish(result)
