"""Jaccard self-join of documents on word shingles by a grouped prefix join.

A document is the set of its distinct shingles, as 64-bit fingerprints. Documents with equal sets are
one node. All sets are sorted by one order: rarer shingles first, as counted by a sketch of fixed
size over the whole corpus, then by fingerprint. Sets that are similar enough share a shingle in the
first few of that order (the prefix), so only those are joined.

1. Nodes with the same prefix and the same size form a group; a group enters the prefix join once.
2. Groups that share a prefix shingle are paired, if their sizes, the places of the shingle and a
   parity bitmap of the sets leave room for the overlap needed.
3. Surviving pairs are expanded to the members of the groups. Those that a parity bitmap of their
   sets does not rule out are verified on the whole sets.

The result wanted is components, so pairs inside a component found already need no proof. Steps 2
and 3 therefore run twice: first with one pivot for each shingle and size class and for each group,
which is linear and joins up most near copies; then for all pairs whose ends are still in different
components. No pair of different components is skipped, so components are exact. Copies that are
near a text but not near enough to link are compared with one another, as any exact join must; such
pairs end at the bitmap, inside the join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyward.llm.bitmap import maybe_wanted
from tallyward.llm.components import components
from tallyward.llm.shingles import shingle_sets
from tallyward.sources.scratch import Scratch

# The sketch counts fingerprints by their last bits, in stretches of this many counters.
SKETCH_BITS, STRETCH = 18, 4096
# Bits of the parity bitmap that travels with a posting, and how many shingles tell pairs met before.
WORD_BITS, EARLIER = 512, 16
WORDS = tuple(f"w{i}" for i in range(WORD_BITS // 64))


def _joined(sets: Iterator[np.ndarray], items: int = 1 << 20) -> Iterator[np.ndarray]:
    """The sets end to end, in stretches of at least ``items``."""
    held, size = [], 0
    for found in sets:
        held.append(found)
        size += len(found)
        if size >= items:
            yield np.concatenate(held)
            held, size = [], 0
    if held:
        yield np.concatenate(held)


def odd_bits(found: np.ndarray, size: int = 0) -> bytes:
    """A bit for each remainder of the fingerprints, set if an odd number of them has it.

    There are ``size`` bits, or as many as items, up to the next power of two: half of a longer row
    folded on the other half is the row of half the length.
    """
    size = size or max(64, 1 << (len(found) - 1).bit_length())
    places = (found >> np.uint64(20)) & np.uint64(size - 1)
    return np.packbits(np.bincount(places.astype(np.int64), minlength=size) & 1).tobytes()


def differing(x: bytes, y: bytes) -> int:
    """How many bits differ, the longer row folded to the length of the other."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) != len(b):
        if len(a) < len(b):
            a, b = b, a
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


@dataclass(frozen=True)
class JaccardJoin:
    """Documents link when ``100 * shared >= percent * joint`` shingles of ``words`` words."""

    words: int = 4
    percent: int = 85
    key: str = "doc_id"
    text: str = "text"

    # ---- sets and prefixes

    def sketch(self, docs: DataFrame) -> np.ndarray:
        """In how many documents a shingle with these last bits occurs; of fixed size."""
        words, size = self.words, 1 << SKETCH_BITS
        low = np.uint64(size - 1)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size, np.int64)
            for batch in batches:
                for found in _joined(shingle_sets(batch.column(0), words)):
                    total += np.bincount((found & low).astype(np.int64), minlength=size)
            parts = total.reshape(-1, STRETCH)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(parts)), pa.int32()), pa.array([p.tobytes() for p in parts])],
                ["part", "counts"],
            )

        def add(_: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(c, np.int64) for c in frame["counts"])
            return pd.DataFrame({"part": [frame["part"].iloc[0]], "counts": [total.tobytes()]})

        schema = "part int, counts binary"
        parts = (
            docs.select(self.text)
            .mapInArrow(count, schema)
            .groupBy("part")
            .applyInPandas(add, schema)
            .collect()  # size / STRETCH rows of fixed size
        )
        total = np.zeros(size, np.int64)
        for row in parts:
            at = row["part"] * STRETCH
            total[at : at + STRETCH] = np.frombuffer(row["counts"], np.int64)
        return total

    def prefixes(self, docs: DataFrame, sketch: np.ndarray) -> DataFrame:
        """(id, thash, n, node, grp, bits, words, prefix) of each document (id, thash, text).

        ``node`` identifies the set, ``grp`` its prefix and size; both null for an empty set.
        ``bits`` has a bit for each remainder of the fingerprints, set if an odd number have it;
        ``words`` are the same for `WORD_BITS` bits, whatever the size of the set. A task lists the
        prefix of a group once, so copies add a row per task to the prefix join.
        """
        width, percent, low = self.words, self.percent, np.uint64((1 << SKETCH_BITS) - 1)
        kind = docs.schema["id"].dataType.simpleString()
        # ranks of counts, small enough for every task
        rank = docs.sparkSession.sparkContext.broadcast(
            np.unique(sketch, return_inverse=True)[1].astype(np.int32)
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            listed: set[int] = set()
            for batch in batches:
                n, node, grp, bits, words, prefix = [], [], [], [], [], []
                for found in shingle_sets(batch.column(2), width):
                    size = len(found)
                    n.append(size)
                    if not size:
                        node.append(None)
                        grp.append(None)
                        bits.append(None)
                        words.append(None)
                        prefix.append(None)
                        continue
                    order = np.argsort(rank.value[(found & low).astype(np.int64)], kind="stable")
                    take = size - -(-percent * size // 100) + 1
                    first = found[order[:take]]
                    node.append(xxhash.xxh3_128_digest(found.tobytes()))
                    name = xxhash.xxh3_64_intdigest(first.tobytes(), size) - (1 << 63)
                    grp.append(name)
                    bits.append(odd_bits(found))
                    words.append(np.frombuffer(odd_bits(found, WORD_BITS), np.int64))
                    prefix.append(None if name in listed else first.view(np.int64))
                    listed.add(name)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array(n, pa.int64()),
                        pa.array(node, pa.binary()),
                        pa.array(grp, pa.int64()),
                        pa.array(bits, pa.binary()),
                        pa.array(words, pa.list_(pa.int64())),
                        pa.array(prefix, pa.list_(pa.int64())),
                    ],
                    ["id", "thash", "n", "node", "grp", "bits", "words", "prefix"],
                )

        return docs.select("id", "thash", "text").mapInArrow(
            run,
            f"id {kind}, thash bigint, n bigint, node binary, grp bigint, bits binary, "
            "words array<bigint>, prefix array<bigint>",
        )

    def _fits(self, x: str, y: str):
        """Whether groups x and y can overlap enough, by sizes and the places of a shared shingle."""
        n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
        room = 1 + F.least(n - F.col(f"{x}.at"), m - F.col(f"{y}.at"))
        shared = room + F.least(F.col(f"{x}.at"), F.col(f"{y}.at")) - 1
        enough = (100 + self.percent) * shared >= self.percent * (n + m)
        return enough & (100 * F.least(n, m) >= self.percent * F.greatest(n, m))

    def _near(self, x: str, y: str):
        """Whether the bitmaps leave room for a link; true where a group has none."""
        apart = sum(
            (F.bit_count(F.col(f"{x}.{w}").bitwiseXOR(F.col(f"{y}.{w}"))) for w in WORDS), F.lit(0)
        )
        most = (100 - self.percent) * (F.col(f"{x}.n") + F.col(f"{y}.n"))
        return F.coalesce((100 + self.percent) * apart <= most, F.lit(True))

    # ---- verification

    def possible(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """The pairs (a, b) of nodes that their bits do not rule out.

        A bit that differs stands for at least one shingle that only one of the sets has.
        """
        percent = self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4, 5))):
                    apart = differing(x, y)
                    keep.append((100 + percent) * apart <= (100 - percent) * (n + m))
                yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

        known = nodes.select("node", "n", "bits")
        x, y = known.alias("x"), known.alias("y")
        return (
            pairs.join(x, F.col("a") == F.col("x.node"))
            .join(y, F.col("b") == F.col("y.node"))
            .select("a", "b", "x.n", "y.n", "x.bits", "y.bits")
            .toDF("a", "b", "n", "m", "x", "y")
            .mapInArrow(run, "a binary, b binary")
        )

    def verified(
        self, pairs: DataFrame, docs: DataFrame, nodes: DataFrame, scratch: Scratch, name: str
    ) -> DataFrame:
        """The pairs (a, b) of nodes that link, by the whole sets of their documents."""
        words, percent = self.words, self.percent
        pairs = scratch.keep(self.possible(pairs, nodes), f"{name}-possible")
        ends = pairs.select(F.col("a").alias("node")).unionByName(
            pairs.select(F.col("b").alias("node"))
        )
        wanted = scratch.keep(
            nodes.join(ends.distinct(), "node", "left_semi").select(
                F.col("one.id").alias("id_"), F.col("one.thash").alias("thash_"), "node"
            ),
            f"{name}-wanted",
        )

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [s.tobytes() for s in shingle_sets(batch.column(1), words)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(found, pa.binary())], ["node", "items"]
                )

        some = maybe_wanted(docs, "thash", wanted.select(F.col("thash_").alias("thash")))
        on = some["id"].eqNullSafe(wanted["id_"]) & (some["thash"] == wanted["thash_"])
        items = scratch.keep(
            some.join(wanted, on)
            .select("node", "text")
            .dropDuplicates(["node"])
            .mapInArrow(sets, "node binary, items binary"),
            f"{name}-sets",
        )

        def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for a, b in zip(batch.column(2), batch.column(3)):
                    x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (a, b))
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
                yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

        # both sides read the same exchange
        x, y = items.alias("x"), items.alias("y")
        linked = (
            pairs.join(x, F.col("a") == F.col("x.node"))
            .join(y, F.col("b") == F.col("y.node"))
            .select("a", "b", "x.items", "y.items")
            .toDF("a", "b", "x", "y")
            .mapInArrow(link, "a binary, b binary")
        )
        found = scratch.keep(linked, f"{name}-links")
        scratch.remove(f"{name}-sets")
        return found

    # ---- the join

    def classes(self, docs: DataFrame) -> DataFrame:
        """(key, n_shingles, component_id) of every row.

        ``component_id`` is the smallest key reachable by links. A null or wordless text has an
        empty set and links with nothing, so its component is its own key. Rows with equal sets are
        always linked; rows that repeat a key with different texts are told apart by a hash of the
        text and may be in different components. Null keys are passed over as component ids unless
        a component has no other. Texts are read whole, however long. An empty table gives an empty
        result. Other columns are not read.
        """
        labelled = self.labelled(docs)
        # stored, so that the join can be split where a component is hot
        least = Scratch.create(docs.sparkSession).keep(
            labelled.filter("component IS NOT NULL")
            .groupBy("component")
            .agg(F.min("id").alias("component_id")),
            "least",
        )
        own = F.col("component").isNull()
        return labelled.join(least, "component", "left").select(
            F.col("id").alias(self.key),
            F.col("n").alias("n_shingles"),
            F.when(own, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        )

    def labelled(self, docs: DataFrame) -> DataFrame:
        """(id, thash, n, component) of every row; the component of an empty set is null."""
        scratch = Scratch.create(docs.sparkSession)
        rows = docs.select(
            F.col(self.key).alias("id"),
            F.xxhash64(self.text).alias("thash"),
            F.col(self.text).alias("text"),
        )
        full = scratch.keep(self.prefixes(rows, self.sketch(docs)), "prefixes")
        postings = full.select("grp", "n", F.posexplode("prefix").alias("at", "token"))
        dealt = postings.repartition("token")
        # copies of a group in several tasks are no reason to look at a shingle
        shared = (
            dealt.groupBy("token")
            .agg(F.min("grp").alias("low"), F.max("grp").alias("high"))
            .filter("low <> high")
            .select("token")
        )
        held = scratch.keep(dealt.join(shared, "token", "left_semi").distinct(), "postings")
        nodes = scratch.keep(
            full.filter("node IS NOT NULL")
            .groupBy("node", "n", "grp")
            .agg(
                F.min(F.struct("id", "thash")).alias("one"),
                F.first("bits").alias("bits"),
                F.first("words").alias("words"),
            ),
            "nodes",
        )
        listed = scratch.keep(full.select("id", "thash", "n", "node"), "listed")
        scratch.remove("prefixes")
        links = self._links(rows, nodes, held, scratch)
        comp = components(links, scratch).withColumnRenamed("id", "node")
        return scratch.finish(
            listed.select("id", "thash", "n", "node")
            .join(comp, "node", "left")
            .select("id", "thash", "n", F.coalesce("component", "node").alias("component"))
        )

    def _links(
        self, docs: DataFrame, nodes: DataFrame, held: DataFrame, scratch: Scratch
    ) -> DataFrame:
        """Links of nodes (a, b), enough of them to connect every component."""
        members = nodes.select("node", "grp", "n")
        one = F.count("*") == 1  # groups of several sets have no bitmap of their own
        heads = nodes.groupBy("grp", "n").agg(
            F.min("node").alias("head"),
            F.count("*").alias("members"),
            *[F.when(one, F.first(F.col("words")[i])).alias(w) for i, w in enumerate(WORDS)],
        )
        heads = scratch.keep(heads, "heads")
        large = heads.filter("members > 1")
        touched = held.select("grp", "n").unionByName(large.select("grp", "n")).distinct()

        ends = [
            F.col(f"{side}.{c}").alias(name)
            for side, c, name in (("x", "grp", "g"), ("x", "n", "m"), ("y", "grp", "h"), ("y", "n", "k"))
        ]
        # pivots: the smallest group of each shingle and size class, the smallest node of each group
        step = math.log(100 / self.percent)
        size = F.floor(F.log(F.col("n").cast("double")) / step)
        posted = held.withColumn("size", size)
        # the fewer rarer shingles a set has, the more central it is among its near copies
        first = posted.groupBy("token", "size").agg(F.min(F.struct("at", "grp", "n")).alias("p"))
        pivots = (
            posted.alias("y")
            .join(first.select("token", "size", "p.grp", "p.n", "p.at").alias("x"), ["token", "size"])
            .filter((F.col("x.grp") != F.col("y.grp")) & self._fits("x", "y"))
            .select(*ends)
            .distinct()
        )
        head = heads.select("grp", "n", "head")
        pairs = (
            pivots.join(head.toDF("g", "m", "a"), ["g", "m"])
            .join(head.toDF("h", "k", "b"), ["h", "k"])
            .select("a", "b")
            .unionByName(
                members.join(large.select("grp", "n", "head"), ["grp", "n"])
                .filter("node <> head")
                .select(F.col("head").alias("a"), F.col("node").alias("b"))
            )
        )
        pairs = scratch.keep(
            pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
            "pivot-pairs",
        )
        links = self.verified(pairs, docs, nodes, scratch, "pivot")
        comp = scratch.keep(components(links, scratch, "pivot"), "pivot-components")

        # all other pairs: of groups that are not wholly in one component
        of_node = members.join(comp.withColumnRenamed("id", "node"), "node", "left").withColumn(
            "component", F.coalesce("component", "node")
        )
        of_node = scratch.keep(of_node.join(touched, ["grp", "n"], "left_semi"), "members")
        span = of_node.groupBy("grp", "n").agg(
            F.min("component").alias("low"), F.max("component").alias("high")
        )
        spread = held.join(span, ["grp", "n"])
        mixed = (
            spread.groupBy("token")
            .agg(F.min("low").alias("l"), F.max("high").alias("h"))
            .filter("l <> h")
            .select("token")
        )
        spread = scratch.keep(spread.join(mixed, "token", "left_semi"), "open-tokens")
        some = F.slice(F.array_sort(F.collect_list(F.struct("at", "token"))), 1, EARLIER)
        firsts = spread.groupBy("grp", "n").agg(some.alias("firsts"))
        spread = scratch.keep(
            spread.join(firsts, ["grp", "n"])
            .join(heads.select("grp", "n", *WORDS), ["grp", "n"])
            .withColumn(
                "earlier", F.expr("transform(filter(firsts, t -> t.at < at), t -> t.token)")
            )
            .drop("firsts"),
            "open-postings",
        )
        x, y = spread.alias("x"), spread.alias("y")
        met = (F.col("x.token") == F.col("y.token")) & (F.col("x.grp") < F.col("y.grp"))
        apart = (F.col("x.low") != F.col("y.low")) | (F.col("x.high") != F.col("y.high")) | (
            F.col("x.low") != F.col("x.high")
        )
        # a pair is taken at the first shingle that it shares, as far as the rows know it
        new = ~F.arrays_overlap("x.earlier", "y.earlier")
        across = (
            x.join(y, met & apart & self._fits("x", "y") & self._near("x", "y") & new)
            .select(*ends)
            .distinct()
        )
        inside = span.filter("low <> high").selectExpr("grp AS g", "n AS m", "grp AS h", "n AS k")
        left = of_node.selectExpr("grp AS g", "n AS m", "node AS a", "component AS ca")
        right = of_node.selectExpr("grp AS h", "n AS k", "node AS b", "component AS cb")
        rest = (
            across.unionByName(inside)
            .join(left, ["g", "m"])
            .join(right, ["h", "k"])
            .filter("ca <> cb")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct()
            .join(pairs, ["a", "b"], "left_anti")
        )
        rest = scratch.keep(rest, "other-pairs")
        return links.unionByName(self.verified(rest, docs, nodes, scratch, "other"))


def one_of_each(docs: DataFrame, join: JaccardJoin | None = None) -> DataFrame:
    """One row of ``docs`` for each component, with its columns: the one with the smallest key.

    Rows with an empty set all stay. Of rows alike in key and text the one that sorts first by its
    other columns stays; a null key stays only where its component has no other. An empty table
    stays empty, and texts of any length are compared whole.
    """
    join = join or JaccardJoin()
    found = join.labelled(docs)
    order = F.struct(F.col("id").isNull().alias("none"), "id", "thash")
    first = found.filter("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("one"))
    kept = first.select(F.col("one.id").alias("_id"), F.col("one.thash").alias("_thash"))
    worded = F.coalesce(join.text, F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    rest = [F.col(c) for c in docs.columns if c not in (join.key, join.text)]
    alike = W.partitionBy(join.key, "_hash").orderBy(*rest, join.text)
    one = (
        docs.filter(worded)
        .withColumn("_hash", F.xxhash64(join.text))
        .join(
            kept,
            F.col(join.key).eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_thash")),
        )
        .withColumn("_nth", F.row_number().over(alike))
        .filter("_nth = 1")
        .select(*docs.columns)
    )
    return one.unionByName(docs.filter(~worded))
