"""Near-duplicate vectors by sign hashing in several tables, exact cosines and components.

Each table cuts space with random hyperplanes through the origin; the signs of a vector are its code.
Two vectors at an angle t agree on a sign with probability 1 - t / pi, so with the default 24 tables
of 16 signs a pair at cosine 0.98 meets in some table with probability 0.99996. Vectors that meet,
with the same label and dimension, are compared by their cosine in double precision.

Equal vectors are one node with a count, so a group of exact copies costs one row however large. A
pair is taken from the first table in which it meets and from no other. Nodes that are near but not
equal have to be compared in pairs, because the result counts their links.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.components import components
from tallyward.sources.scratch import Scratch


@dataclass(frozen=True)
class NearVectors:
    cosine: float = 0.98
    tables: int = 24
    signs: int = 16
    seed: int = 7
    key: str = "vec_id"
    vector: str = "embedding"
    label: str = "label"

    def coded(self, vectors: DataFrame) -> DataFrame:
        """(id, node, near, codes, vector): null node for vectors that can link with nothing.

        ``near`` is what must be equal for a link, label and dimension.
        """
        tables, signs, seed = self.tables, self.signs, self.seed
        kind = vectors.schema[self.key].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            planes: dict[int, np.ndarray] = {}
            bits = 1 << np.arange(signs, dtype=np.int64)
            for batch in batches:
                node, near, codes, kept = [], [], [], []
                for label, scalar in zip(batch.column(1).to_pylist(), batch.column(2)):
                    values = scalar.values if scalar.is_valid else None
                    vector = None
                    if label is not None and values is not None and len(values) and not values.null_count:
                        vector = values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                        if not np.isfinite(vector).all() or not vector.any():
                            vector = None
                    if vector is None:
                        for column in (node, near, codes, kept):
                            column.append(None)
                        continue
                    size = len(vector)
                    if size not in planes:
                        rng = np.random.default_rng([seed, size])
                        planes[size] = rng.standard_normal((size, tables * signs))
                    node.append(xxhash.xxh3_128_digest(vector.tobytes() + str(label).encode()))
                    peak = np.abs(vector).max()
                    if not 1e-150 < peak < 1e150:  # squares would leave the range of doubles
                        vector = vector / peak
                    sign = (vector @ planes[size] > 0).reshape(tables, signs)
                    near.append(f"{label}:{size}")
                    codes.append((sign @ bits).astype(np.int32))
                    kept.append(vector.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(node, pa.binary()),
                        pa.array(near, pa.string()),
                        pa.array(codes, pa.list_(pa.int32())),
                        pa.array(kept, pa.binary()),
                    ],
                    ["id", "node", "near", "codes", "vector"],
                )

        return vectors.select(self.key, self.label, self.vector).mapInArrow(
            run, f"id {kind}, node binary, near string, codes array<int>, vector binary"
        )

    def links(self, nodes: DataFrame, scratch: Scratch) -> DataFrame:
        """Pairs (a, b) of different nodes whose cosine reaches the threshold."""
        met = nodes.select("node", "near", "codes", F.posexplode("codes").alias("tbl", "code"))
        x, y = met.alias("x"), met.alias("y")
        first = F.expr(
            "array_position(zip_with(x.codes, y.codes, (p, q) -> p = q), true) = x.tbl + 1"
        )
        same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("near", "tbl", "code")]
        pairs = scratch.keep(
            x.join(y, same[0] & same[1] & same[2] & (F.col("x.node") < F.col("y.node")) & first)
            .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")),
            "pairs",
        )
        least = self.cosine

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                size = pc.binary_length(batch.column(2)).to_numpy()
                for width in np.unique(size):
                    part = batch.filter(pa.array(size == width))
                    u, v = (
                        np.frombuffer(b"".join(part.column(c).to_pylist())).reshape(part.num_rows, -1)
                        for c in (2, 3)
                    )
                    dot, uu, vv = (np.einsum("ij,ij->i", x, y) for x, y in ((u, v), (u, u), (v, v)))
                    keep = dot / np.sqrt(uu * vv) >= least
                    yield part.select([0, 1]).filter(pa.array(keep))

        left = nodes.select(F.col("node").alias("a"), F.col("vector").alias("u"))
        right = nodes.select(F.col("node").alias("b"), F.col("vector").alias("v"))
        return (
            pairs.join(left, "a").join(right, "b").select("a", "b", "u", "v")
            .mapInArrow(run, "a binary, b binary")
        )

    def classes(self, vectors: DataFrame) -> DataFrame:
        """(key, n_links, component_id, kept) of every row.

        A vector that is null, empty, zero, or holds null or non-finite components, and one without
        a label, links with nothing: it has no links and is its own component. Equal vectors of one
        label always link, repeated keys included: rows are counted, not keys. Null keys are passed
        over as component ids unless a component has no other. Other columns are not read.
        """
        scratch = Scratch.create(vectors.sparkSession)
        rows = scratch.keep(self.coded(vectors), "coded")
        nodes = scratch.keep(
            rows.filter("node IS NOT NULL")
            .groupBy("node")
            .agg(
                F.count("*").alias("copies"),
                F.min("id").alias("least"),
                F.first("near").alias("near"),
                F.first("codes").alias("codes"),
                F.first("vector").alias("vector"),
            ),
            "nodes",
        )
        links = scratch.keep(self.links(nodes, scratch), "links")
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        counts = nodes.select("node", "copies", "least")
        others = (
            both.join(counts.select(F.col("node").alias("b"), "copies"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.sum("copies").alias("others"))
        )
        comp = components(links, scratch).withColumnRenamed("id", "node")
        known = counts.join(others, "node", "left").join(comp, "node", "left").select(
            "node",
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
            "least",
        )
        known = scratch.keep(known, "known")
        # stored, so that the join can be split where a component is hot
        least = scratch.keep(
            known.groupBy("component").agg(F.min("least").alias("component_id")), "least"
        )
        known = known.join(least, "component").select("node", "n_links", "component_id")
        own = F.col("node").isNull()
        return scratch.finish(
            rows.select("id", "node")
            .join(known, "node", "left")
            .select(
                F.col("id").alias(self.key),
                F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
                F.when(own, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
                (own | F.col("id").eqNullSafe(F.col("component_id"))).alias("kept"),
            )
        )
