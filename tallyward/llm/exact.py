"""Exact deduplication by distributed MSD radix partitioning.

Documents start in one group. Each level looks at the next block of bytes of the normalised text and
splits every group by it. A group that is down to one document, or whose block ends the text, is
finished; the others go on to the next level with the bytes they have left. Blocks grow by a factor,
so a text of n bytes passes O(log n) levels, and texts are equal only if all their bytes are: no
digest decides.

At scale: a level first counts its groups with map-side combining, so a group of copies costs one row
per task however large it is; the join that hands group numbers back is a sort-merge join whose hot
groups adaptive execution splits. The first level is the only one that moves whole texts, later ones
move what is left of texts that still share all bytes so far. Each level is a stored table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyward.sources.scratch import Scratch

# Fixed value: the white space of the normal form, as a Java pattern.
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normal_text(text: Column) -> Column:
    """Null as empty, each run of white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


@dataclass(frozen=True)
class RadixDedup:
    """``first_block`` bytes at the first level, ``growth`` times more at each next one."""

    key: str = "doc_id"
    text: str = "text"
    first_block: int = 256
    growth: int = 16

    def groups(self, docs: DataFrame) -> DataFrame:
        """(key, keep_id, group_size, kept, text_sha256) for every row.

        ``keep_id`` is the smallest key of the rows with an equal normal text. Null texts equal
        empty ones. Rows repeated with the same key are rows of the group: each counts, and those
        with the smallest key are all marked kept. A null key sorts after all others. An empty
        table gives an empty result, and further columns of ``docs`` play no part.
        """
        scratch = Scratch.create(docs.sparkSession)
        level, width, done = 0, self.first_block, None
        rows = docs.select(
            F.col(self.key).alias("id"),
            F.lit(None).cast(docs.schema[self.key].dataType).alias("grp"),
            F.lit(0).cast("bigint").alias("salt"),
            F.lit(0).alias("nth"),
            normal_text(F.col(self.text)).cast("binary").alias("rest"),
        )
        while True:
            table = scratch.keep(self._split(rows, width, level == 0), f"level={level}")
            ended = table.filter("rest IS NULL").drop("rest", "grp", "salt", "nth")
            done = ended if done is None else done.unionByName(ended)
            rows = table.filter("rest IS NOT NULL").drop("keep_id", "group_size")
            if rows.isEmpty():
                break
            level, width = level + 1, width * self.growth
        return scratch.finish(
            done.select(
                F.col("id").alias(self.key),
                "keep_id",
                "group_size",
                F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                "text_sha256",
            )
        )

    def _split(self, rows: DataFrame, width: int, first: bool) -> DataFrame:
        """One level: group rows by their next block; ``rest`` is null where a row is finished.

        A group that goes on is known by its smallest key and, for keys that are null or repeated
        with different texts, by a hash of what the group shares and its place among the groups of
        that key and hash. A key with many groups is so numbered in many tasks. All are functions of
        the data, so a task that runs again gives the same numbers.
        """
        rows = rows.withColumn("block", F.substring("rest", 1, width))
        same = rows.groupBy("grp", "salt", "nth", "block").agg(
            F.count("*").alias("group_size"), F.min("id").alias("keep_id")
        )
        same = same.filter("group_size > 1").withColumn("own", F.xxhash64("grp", "salt", "nth", "block"))
        same = same.select(
            F.col("grp").alias("g"),
            F.col("salt").alias("s"),
            F.col("nth").alias("n"),
            F.col("block").alias("b"),
            "group_size",
            "keep_id",
            "own",
            F.row_number()
            .over(W.partitionBy("keep_id", "own").orderBy("grp", "salt", "nth", "block"))
            .alias("place"),
        )
        goes_on = F.col("b").isNotNull() & (F.octet_length("block") == width)
        sha = F.sha2(F.col("rest"), 256) if first else F.col("text_sha256")
        return rows.join(
            same,
            F.col("grp").eqNullSafe(F.col("g"))
            & (F.col("salt") == F.col("s"))
            & (F.col("nth") == F.col("n"))
            & (F.col("block") == F.col("b")),
            "left",
        ).select(
            "id",
            F.when(F.col("b").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
            sha.alias("text_sha256"),
            F.col("keep_id").alias("grp"),
            F.col("own").alias("salt"),
            F.col("place").alias("nth"),
            F.when(goes_on, F.expr(f"substring(rest, {width + 1})")).alias("rest"),
        )


def first_of_each(docs: DataFrame, dedup: RadixDedup | None = None) -> DataFrame:
    """One row of ``docs`` for each distinct normal text, with its columns: that with the smallest
    key, and of rows alike in key and text the one that sorts first by its other columns."""
    dedup = dedup or RadixDedup()
    kept = dedup.groups(docs).filter("kept").select(
        F.col(dedup.key).alias("_key"), F.col("text_sha256").alias("_sha")
    )
    sha = F.sha2(normal_text(F.col(dedup.text)).cast("binary"), 256)
    rest = [F.col(c) for c in docs.columns if c not in (dedup.key, dedup.text)]
    one = W.partitionBy(dedup.key, "_own").orderBy(*rest, dedup.text)
    on = F.col(dedup.key).eqNullSafe(F.col("_key")) & (F.col("_own") == F.col("_sha"))
    return (
        docs.withColumn("_own", sha)
        .join(kept, on, "left_semi")
        .withColumn("_nth", F.row_number().over(one))
        .filter("_nth = 1")
        .drop("_own", "_nth")
    )
