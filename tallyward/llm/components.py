"""Connected components of an edge table, as alternating star rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.sources.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(id, component) of every id of the edges (a, b); component is its smallest reachable id.

    Large-star and small-star rounds: every node links its larger neighbours, then its smaller ones,
    to the smallest node it knows. The edges end as stars around the smallest ids, after a number of
    rounds logarithmic in the size of a component. A hub costs no more than its edges: minima are
    combined before the shuffle, and they are stored before they are joined, so both sides of a join
    are plain shuffles, which adaptive execution splits where a node is hot. Each round is a stored
    table; only two counts reach the driver.
    """
    now = scratch.keep(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b")
        .distinct(),
        f"{name}-0",
    )
    turn, before = 0, None
    while True:
        turn += 1
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        low = scratch.keep(low, f"{name}-{turn}-low")
        large = both.join(low, "a").filter("b > a")
        large = large.select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = scratch.keep(large.filter("a <> b").distinct(), f"{name}-{turn}-large")
        low = scratch.keep(
            large.groupBy("a").agg(F.min("b").alias("low")), f"{name}-{turn}-lower"
        )
        small = large.join(low, "a")
        small = (
            small.select("a", F.col("low").alias("b"))
            .unionByName(small.select(F.col("b").alias("a"), F.col("low").alias("b")))
            .filter("a <> b")
            .distinct()
        )
        now = scratch.keep(small, f"{name}-{turn}")
        # done when the edges are stars and stay the same: as many edges as nodes with one, same sum
        state = now.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"),
        ).first()
        if before == state:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
            )
        before = state
