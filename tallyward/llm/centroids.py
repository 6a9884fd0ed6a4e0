"""Centroid clustering in integers with a PCA-rotated lower bound.

Vectors become integer rows, ``floor(scale * x)``, and all results are functions of these integers.
The covariance of all rows gives a rotation; every row is stored with its leading rotated coordinates
and the norm of what the rotation leaves over. For a row v and a centroid c

    |v - c|^2  >=  |lead(v) - lead(c)|^2 + (rest(v) - rest(c))^2,

because the residual parts differ by at least the difference of their norms. A round computes the
exact distance to the centroid of the lowest bound, drops the centroids whose bound lies above it by
more than the rounding of doubles can explain, and verifies the survivors in integers. Ties fall to
the smaller number, so the bound changes time and never a result.

Each round is one scan of the stored rows. A task holds one batch and the sums of its clusters, and
sends one row per cluster and component, so hot clusters cost nothing extra. Sums travel as limbs of
`LIMB` bits, which keeps them exact for every finite double. The driver sees only centroids.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.sources.scratch import Scratch

LIMB = 40
LONG_MAX = (1 << 63) - 1


def room(dimensions: int) -> int:
    """Below this size of all components 64-bit integers hold the squared distance of two rows."""
    return min(math.isqrt(LONG_MAX // max(dimensions, 1)) // 2, (1 << 31) - 1)


def integers(values: np.ndarray, scale: int) -> list[int]:
    """floor(scale * x) of each double, without overflow; ``scale`` is a power of two."""
    return [
        int(x) * scale if abs(x) >= 1 << 53 else math.floor(x * scale) for x in values.tolist()
    ]


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """(place, digit) of a whole number to the base 2^LIMB, with its sign on every digit."""
    sign, value, place = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield place, sign * (value & ((1 << LIMB) - 1))
        value >>= LIMB
        place += 1


def long_or_null(value: int) -> int | None:
    """A squared distance or a sum of some, null where a long cannot hold it."""
    return value if value <= LONG_MAX else None


@dataclass(frozen=True)
class Rotation:
    """The leading axes of the rows' covariance around their mean."""

    mean: np.ndarray
    axes: np.ndarray

    def project(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(leading coordinates, norm of the rest, squared norm) of rows of doubles."""
        centred = rows - self.mean
        lead = centred @ self.axes
        size = np.einsum("ij,ij->i", centred, centred)
        rest = np.sqrt(np.maximum(size - np.einsum("ij,ij->i", lead, lead), 0))
        return lead, rest, size


class Centres:
    """The centroids of one round, ready to be compared with rows."""

    def __init__(self, rows: list[list[int]], rotation: Rotation):
        self.rows = rows
        self.small = all(abs(x) < room(len(row)) for row in rows for x in row)
        if self.small:
            self.ints = np.array(rows, np.int64)
            self.lead, self.rest, self.size = rotation.project(self.ints.astype(np.float64))

    def nearest(
        self, ints: np.ndarray, lead: np.ndarray, rest: np.ndarray, size: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, squared distance) of rows of small integers."""
        if not self.small:
            found = [self.exact(row) for row in ints.tolist()]
            return np.array([c for c, _ in found]), [d for _, d in found]
        bound = np.zeros((len(ints), len(self.rows)))
        for c in range(len(self.rows)):
            part = lead - self.lead[c]
            bound[:, c] = np.einsum("ij,ij->i", part, part) + (rest - self.rest[c]) ** 2
        # far above the rounding of a few hundred operations on doubles
        slack = 1e-9 * (size[:, None] + self.size + 1)
        best = bound.argmin(axis=1)
        least = self._distance(ints, best)
        for c in range(len(self.rows)):
            left = np.flatnonzero((bound[:, c] - slack[:, c] <= least) & (best != c))
            if not len(left):
                continue
            there = self._distance(ints[left], np.full(len(left), c))
            better = (there < least[left]) | ((there == least[left]) & (c < best[left]))
            best[left[better]] = c
            least[left[better]] = there[better]
        return best, least

    def _distance(self, ints: np.ndarray, which: np.ndarray) -> np.ndarray:
        part = ints - self.ints[which]
        return np.einsum("ij,ij->i", part, part)

    def exact(self, row: list[int]) -> tuple[int, int]:
        """The nearest centroid of one row of whole numbers of any size."""
        found = [sum((x - y) ** 2 for x, y in zip(row, centre)) for centre in self.rows]
        least = min(found)
        return found.index(least), least


@dataclass(frozen=True)
class CentroidClusters:
    """Lloyd's rounds from chosen start rows; see the module for the method."""

    clusters: int = 8
    rounds: int = 10
    seed: int = 3
    dimensions: int = 64
    scale: int = 1024
    leading: int = 16
    key: str = "vec_id"
    vector: str = "embedding"

    def usable(self, v: Column) -> Column:
        """Vectors of the right size whose components are all there and finite."""
        bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        return (F.size(v) == self.dimensions) & ~bad

    def classes(self, vectors: DataFrame) -> DataFrame:
        """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable row.

        Rows whose vector is null, has another size, or holds null or non-finite components are left
        out. Repeated rows count as often as they are there. Null keys come last in the choice of the
        start rows; equal keys start in the order of their vectors. With fewer rows than clusters
        there are as many centroids as rows, and without rows there is no result. A distance or sum
        beyond a long is null. Other columns are not read.
        """
        spark = vectors.sparkSession
        scratch = Scratch.create(spark)
        plain = vectors.select(
            F.col(self.key).alias("id"), F.col(self.vector).cast("array<double>").alias("v")
        ).filter(self.usable(F.col("v")))
        centres = self.start(plain)
        if not centres:
            return spark.createDataFrame([], self._schema(vectors))
        rotation = self.fit_rotation(plain)
        rows = scratch.keep(self.rotated(plain, rotation), "rotated")
        for _ in range(self.rounds):
            centres = self.moved(rows, centres, rotation)
        final = scratch.keep(self.assigned(rows, centres, rotation), "assigned")
        return scratch.finish(self._described(final, centres, vectors))

    def start(self, plain: DataFrame) -> list[list[int]]:
        """The rows of the smallest hashes, as whole numbers; as many as there are clusters."""
        order = F.when(F.col("id").isNotNull(), F.sha2(F.concat(F.lit(f"{self.seed}:"), "id"), 256))
        first = plain.select("v", order.alias("h")).orderBy(F.col("h").asc_nulls_last(), "v")
        return [integers(np.array(r["v"]), self.scale) for r in first.limit(self.clusters).collect()]

    def fit_rotation(self, plain: DataFrame) -> Rotation:
        """Mean and leading axes of all rows that are small enough for 64-bit integers."""
        n, scale, limit = self.dimensions, self.scale, room(self.dimensions)

        def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((n + 1, n + 1))
            for batch in batches:
                with np.errstate(over="ignore"):
                    rows = np.floor(_matrix(batch.column(0), n) * scale)
                rows = rows[np.abs(rows).max(axis=1, initial=0) < limit]
                rows = np.hstack([rows, np.ones((len(rows), 1))])
                total += rows.T @ rows
            upper = np.triu_indices(n + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(upper[0])), pa.int32()), pa.array(total[upper])],
                ["place", "value"],
            )

        found = (
            plain.select("v")
            .mapInArrow(moments, "place int, value double")
            .groupBy("place")
            .agg(F.sum("value").alias("value"))
            .collect()  # one row per pair of dimensions
        )
        flat = np.zeros((n + 1) * (n + 2) // 2)
        for r in found:
            flat[r["place"]] = r["value"]
        total = np.zeros((n + 1, n + 1))
        total[np.triu_indices(n + 1)] = flat
        total = total + np.triu(total, 1).T
        count = max(total[n, n], 1.0)
        mean = total[n, :n] / count
        _, axes = np.linalg.eigh(total[:n, :n] / count - np.outer(mean, mean))
        return Rotation(mean, np.ascontiguousarray(axes[:, ::-1][:, : min(self.leading, n)]))

    def rotated(self, plain: DataFrame, rotation: Rotation) -> DataFrame:
        """(id, ints, lead, rest, size): packed integers and rotated coordinates of each row.

        A row with a component that 64-bit distances cannot hold has ``big``, its integers as text,
        instead.
        """
        n, scale, limit = self.dimensions, self.scale, room(self.dimensions)
        kind = plain.schema["id"].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = _matrix(batch.column(1), n)
                with np.errstate(over="ignore"):
                    rows = np.floor(values * scale)
                small = np.abs(rows).max(axis=1, initial=0) < limit
                rows[~small] = 0
                lead, rest, size = rotation.project(rows)
                packed = rows.astype(np.int32)
                big = [
                    None if ok else " ".join(map(str, integers(v, scale)))
                    for ok, v in zip(small.tolist(), values)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        _packed(packed),
                        _packed(lead),
                        pa.array(rest),
                        pa.array(size),
                        pa.array(big, pa.string()),
                    ],
                    ["id", "ints", "lead", "rest", "size", "big"],
                )

        schema = f"id {kind}, ints binary, lead binary, rest double, size double, big string"
        return plain.select("id", "v").mapInArrow(run, schema)

    def moved(
        self, rows: DataFrame, centres: list[list[int]], rotation: Rotation
    ) -> list[list[int]]:
        """The centroids after one round: floor(sum / count), empty clusters as they were."""
        n, compared = self.dimensions, Centres(centres, rotation)
        leading = rotation.axes.shape[1]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = [[0] * n for _ in centres]
            counts = [0] * len(centres)
            for batch in batches:
                for ints, which, _ in _compared(batch, compared, n, leading):
                    for c in np.unique(which).tolist():
                        mine = ints[which == c]
                        counts[c] += len(mine)
                        sums[c] = [x + y for x, y in zip(sums[c], mine.sum(axis=0).tolist())]
            found = [
                (c, place, limb, value)
                for c, total in enumerate(counts)
                for place, number in enumerate([total, *sums[c]])
                for limb, value in limbs(number)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f[k] for f in found], kind)
                    for k, kind in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int64()))
                ],
                ["cluster", "place", "limb", "value"],
            )

        sums = (
            rows.select("ints", "lead", "rest", "size", "big")
            .mapInArrow(run, "cluster int, place int, limb int, value bigint")
            .groupBy("cluster", "place", "limb")
            .agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
            .collect()  # one row per cluster, component and limb
        )
        total = [[0] * (n + 1) for _ in centres]
        for r in sums:
            total[r["cluster"]][r["place"]] += int(r["value"]) << (LIMB * r["limb"])
        return [
            [x // t[0] for x in t[1:]] if t[0] else old for old, t in zip(centres, total)
        ]

    def assigned(
        self, rows: DataFrame, centres: list[list[int]], rotation: Rotation
    ) -> DataFrame:
        """(id, cluster, distance, beyond) of every row; ``beyond`` is a distance no long can hold."""
        n, compared = self.dimensions, Centres(centres, rotation)
        leading = rotation.axes.shape[1]
        kind = rows.schema["id"].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cluster = np.zeros(batch.num_rows, np.int32)
                distance = [0] * batch.num_rows
                parts = _compared(batch.select(range(1, 6)), compared, n, leading)
                for at, (_, which, least) in zip(_split(batch.column(5)), parts):
                    cluster[at] = which
                    for i, d in zip(at.tolist(), least):
                        distance[i] = int(d)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(cluster, pa.int32()),
                        pa.array(map(long_or_null, distance), pa.int64()),
                        pa.array([str(d) if d > LONG_MAX else None for d in distance], pa.string()),
                    ],
                    ["id", "cluster", "distance", "beyond"],
                )

        return rows.mapInArrow(run, f"id {kind}, cluster int, distance bigint, beyond string")

    def _described(
        self, final: DataFrame, centres: list[list[int]], vectors: DataFrame
    ) -> DataFrame:
        """The result's columns; inertias are sums over what was assigned."""
        one = F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
        sums = final.groupBy("cluster").agg(one, F.max("beyond").alias("beyond")).collect()
        within = {r["cluster"]: None if r["beyond"] else long_or_null(int(r["total"])) for r in sums}
        beyond = any(r["beyond"] for r in sums)
        whole = None if beyond else long_or_null(sum(int(r["total"]) for r in sums))
        shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
        inertia = F.array(*[F.lit(within.get(c)).cast("bigint") for c in range(len(centres))])
        return final.select(
            F.col("id").alias(self.key),
            "cluster",
            "distance",
            inertia[F.col("cluster")].alias("cluster_inertia"),
            F.lit(whole).cast("bigint").alias("inertia"),
            F.array(*map(F.lit, shas))[F.col("cluster")].alias("centroid_sha256"),
        )

    def _schema(self, vectors: DataFrame) -> str:
        kind = vectors.schema[self.key].dataType.simpleString()
        return (
            f"`{self.key}` {kind}, cluster int, distance bigint, cluster_inertia bigint, "
            "inertia bigint, centroid_sha256 string"
        )


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    """The rows of a column of lists of n doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, n)


def _packed(rows: np.ndarray) -> pa.Array:
    """One binary value per row of a matrix."""
    return pa.array([row.tobytes() for row in np.ascontiguousarray(rows)], pa.binary())


def _unpacked(column: pa.Array, kind: type, n: int) -> np.ndarray:
    found = b"".join(column.to_pylist())
    return np.frombuffer(found, kind).reshape(-1, n)


def _split(big: pa.Array) -> Iterator[np.ndarray]:
    """Places of the rows of small integers, then of the others, as `_compared` takes them."""
    small = np.array(big.is_null())
    if small.any():
        yield np.flatnonzero(small)
    if not small.all():
        yield np.flatnonzero(~small)


def _compared(
    batch: pa.RecordBatch, centres: Centres, n: int, leading: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(integers, nearest centroid, squared distance) of the batch (ints, lead, rest, size, big)."""
    for at in _split(batch.column(4)):
        part = batch.take(pa.array(at))
        if part.column(4)[0].as_py() is None:
            ints = _unpacked(part.column(0), np.int32, n).astype(np.int64)
            lead = _unpacked(part.column(1), np.float64, leading)
            rest, size = (part.column(c).to_numpy() for c in (2, 3))
            yield ints, *centres.nearest(ints, lead, rest, size)
            continue
        rows = [[int(x) for x in text.split(" ")] for text in part.column(4).to_pylist()]
        found = [centres.exact(row) for row in rows]
        yield np.array(rows, object), np.array([c for c, _ in found]), [d for _, d in found]
