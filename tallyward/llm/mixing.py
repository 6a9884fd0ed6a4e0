"""Mixing sources to target weights by hierarchical budgeting.

Documents are leaves' members in a tree domain > language > source. A token budget flows down by the
weights of the children. A child that has fewer tokens than its share, with every document used up to
``max_epochs`` times, is filled up, and what it leaves goes to its siblings by their weights; only
what all siblings together cannot take is left to the next level up. One sort of a node's children by
tokens per weight decides it: the filled ones come first.

Each leaf then reads its documents in a seeded order, once per epoch: whole epochs, and of the last
one the longest prefix of whole documents within the rest of the budget. The order is by a digest of
seed, epoch and key, so where the prefix ends is found by counting tokens in ranges of the digest:
4,096 ranges per leaf, then 4,096 within the one that holds the end, and only what is left of it is
sorted. No leaf is sorted whole, and documents are only filtered, not shuffled.

All amounts are whole tokens (words); nothing is rounded away, so the leaves' budgets add up to the
budget exactly, or to all there is.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyward.sources.scratch import Scratch

LEVELS = ("domain", "lang", "source")
DIGITS = 15  # hexadecimal digits of the order key: 60 bits
RANGE_BITS = 12


def words(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _product(a: str, b: str) -> str:
    return f"CAST({a} AS DECIMAL(20,0)) * CAST({b} AS DECIMAL(17,0))"


@dataclass(frozen=True)
class Mixture:
    """``weights[level][name]`` are whole numbers, 1 where not given; 0 leaves a child out.

    ``share`` (numerator, denominator) is the budget as a part of all tokens; ``domain`` gives the
    domain of a row.
    """

    domain: str = "'all'"
    weights: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    share: tuple[int, int] = (1, 1)
    max_epochs: int = 4
    seed: int = 1
    key: str = "doc_id"
    text: str = "text"

    def _weight(self, level: str) -> Column:
        given = self.weights.get(level, {})
        found = F.lit(1)
        for name, weight in sorted(given.items()):
            found = F.when(F.col(level) == name, weight).otherwise(found)
        return found.cast("bigint")

    def _rows(self, docs: DataFrame) -> DataFrame:
        """(key, levels, tokens) of each document."""
        return docs.select(
            F.col(self.key).alias("key"),
            F.expr(self.domain).cast("string").alias("domain"),
            F.col("lang"),
            F.col("source"),
            words(F.col(self.text)).alias("tokens"),
        )

    def budgets(self, rows: DataFrame) -> DataFrame:
        """(levels, tokens, budget) of every leaf."""
        leaves = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
        for level in LEVELS:
            leaves = leaves.withColumn(f"w_{level}", self._weight(level))
        out = " OR ".join(f"w_{level} = 0" for level in LEVELS)
        leaves = leaves.withColumn(
            "cap", F.expr(f"IF({out}, 0L, tokens * {self.max_epochs})")
        )
        of, to = self.share
        found = None
        for depth, level in enumerate(LEVELS):
            above, here = list(LEVELS[:depth]), list(LEVELS[: depth + 1])
            children = leaves.groupBy(*here, f"w_{level}").agg(
                F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens")
            )
            if found is None:
                root = W.partitionBy()  # a row for each domain
                children = children.withColumn("total", F.sum("tokens").over(root)).withColumn(
                    "budget", F.least(F.expr(f"total * {of} div {to}"), F.sum("cap").over(root))
                )
            else:
                parents = found.select(*[F.col(c).alias(f"p_{c}") for c in above], "budget")
                on = [F.col(c).eqNullSafe(F.col(f"p_{c}")) for c in above]
                children = children.join(parents, on)
            children = children.select(*here, f"w_{level}", "cap", "budget")
            found = self._shared(children, above, level)
        totals = leaves.filter(f"NOT ({out})").select(*[F.col(c).alias(f"p_{c}") for c in LEVELS], "tokens")
        on = [F.col(c).eqNullSafe(F.col(f"p_{c}")) for c in LEVELS]
        return found.join(totals, on).select(*LEVELS, "tokens", "budget")

    @staticmethod
    def _shared(children: DataFrame, above: list[str], level: str) -> DataFrame:
        """Each child's part of its parent's budget: children by ``cap / weight``, full ones first."""
        own = children.filter("cap > 0").withColumnRenamed(f"w_{level}", "w")
        order = W.partitionBy(*above).orderBy(F.expr("CAST(cap AS DOUBLE) / w"), F.col(level))
        before = order.rowsBetween(W.unboundedPreceding, -1)
        own = own.withColumns(
            {
                "filled": F.coalesce(F.sum("cap").over(before), F.lit(0)),
                "passed": F.coalesce(F.sum("w").over(before), F.lit(0)),
                "all_w": F.sum("w").over(W.partitionBy(*above)),
                "nth": F.row_number().over(order),
            }
        ).withColumn(
            "full", F.expr(f"{_product('cap', 'all_w - passed')} <= {_product('budget - filled', 'w')}")
        )
        # from the first child that is not full on, the rest is shared by weight
        first = F.min(F.when(~F.col("full"), F.struct("nth", "filled", "passed"))).over(
            W.partitionBy(*above)
        )
        own = own.withColumn("first", first).withColumn(
            "part",
            F.expr(
                f"""CASE WHEN first IS NULL OR nth < first.nth THEN cap ELSE
                ({_product('budget - first.filled', 'passed + w - first.passed')})
                    div CAST(all_w - first.passed AS DECIMAL(20,0))
                - ({_product('budget - first.filled', 'passed - first.passed')})
                    div CAST(all_w - first.passed AS DECIMAL(20,0)) END"""
            ),
        )
        own = own.select(*above, level, F.least("part", "cap").cast("bigint").alias("budget"))
        none = children.filter("cap = 0").selectExpr(*above, level, "0L AS budget")
        return own.unionByName(none)

    def _order(self) -> Column:
        """Place of a document in the order of its leaf's last epoch."""
        digest = F.md5(
            F.concat_ws(
                "|", F.lit(str(self.seed)), F.col("whole").cast("string"), F.col("key").cast("string")
            ).cast("binary")
        )
        return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("bigint")

    def plan(self, rows: DataFrame, scratch: Scratch) -> DataFrame:
        """(p_levels, whole, cut): whole epochs of a leaf and the end (place, key, tokens) of the
        prefix of the last one, null if there is none."""
        leaves = scratch.keep(
            self.budgets(rows).select(
                *[F.col(c).alias(f"p_{c}") for c in LEVELS],
                F.expr("IF(tokens = 0, 0L, budget div tokens)").alias("whole"),
                F.expr("IF(tokens = 0, 0L, budget % tokens)").alias("rest"),
                F.expr("tokens = 0 OR budget % tokens > 0").alias("partly"),
            ),
            "leaves",
        )
        on = [F.col(c).eqNullSafe(F.col(f"p_{c}")) for c in LEVELS]
        leaf = [f"p_{c}" for c in LEVELS]
        open_ = rows.join(leaves.filter("partly"), on).select(
            *leaf, "rest", "key", "tokens", self._order().alias("place")
        )
        cuts = []
        for depth in (1, 2):
            unit = 1 << (4 * DIGITS - depth * RANGE_BITS)
            open_ = open_.withColumn("range", F.expr(f"place div {unit}L"))
            sums = open_.groupBy(*leaf, "rest", "range").agg(
                F.sum("tokens").alias("tokens"), F.max(F.struct("place", "key", "tokens")).alias("end")
            )
            run = W.partitionBy(*leaf).orderBy("range")
            sums = scratch.keep(
                sums.withColumn("upto", F.sum("tokens").over(run.rowsBetween(W.unboundedPreceding, 0))),
                f"ranges-{depth}",
            )
            cuts.append(sums.filter("upto <= rest").select(*leaf, "end"))
            # the range in which the prefix ends, if it ends inside one
            inside = sums.filter("upto - tokens <= rest AND upto > rest").select(
                *[F.col(c).alias(f"i_{c}") for c in leaf],
                F.col("range").alias("i_range"),
                (F.col("rest") - F.col("upto") + F.col("tokens")).alias("left"),
            )
            at = [F.col(c).eqNullSafe(F.col(f"i_{c}")) for c in leaf] + [F.col("range") == F.col("i_range")]
            open_ = open_.join(inside, at).select(*leaf, F.col("left").alias("rest"), "key", "tokens", "place")
        run = W.partitionBy(*leaf).orderBy(F.struct("place", "key", "tokens"))
        last = open_.withColumn(
            "upto", F.sum("tokens").over(run.rangeBetween(W.unboundedPreceding, 0))
        ).filter("upto <= rest")
        cuts.append(last.select(*leaf, F.struct("place", "key", "tokens").alias("end")))
        ends = cuts[0].unionByName(cuts[1]).unionByName(cuts[2]).groupBy(*leaf).agg(F.max("end").alias("cut"))
        ends = ends.select(*[F.col(c).alias(f"e_{c}") for c in leaf], "cut")
        at = [F.col(c).eqNullSafe(F.col(f"e_{c}")) for c in leaf]
        return scratch.keep(leaves.join(ends, at, "left").select(*leaf, "whole", "cut"), "plan")

    def _taken(self, rows: DataFrame, plan: DataFrame) -> DataFrame:
        """``rows`` once for each epoch that takes them."""
        on = [F.col(c).eqNullSafe(F.col(f"p_{c}")) for c in LEVELS]
        place = F.struct(self._order().alias("place"), "key", "tokens")
        last = F.when(F.col("cut").isNotNull() & (place <= F.col("cut")), 1).otherwise(0)
        times = F.col("whole") + last
        return (
            rows.join(plan, on)
            .withColumn("epochs", F.when(times > 0, F.sequence(F.lit(0).cast("bigint"), times - 1)))
            .withColumn("epoch", F.explode("epochs"))
        )

    def chosen(self, docs: DataFrame) -> DataFrame:
        """(key, domain, lang, source, epoch, n_tokens): a row for each time a document is taken.

        Null languages and sources are names of their own. A null or wordless text has no tokens:
        it costs nothing and is taken where the prefix reaches it. Rows with equal key and tokens
        stand at one place and are taken together. Null keys order first. An empty table gives an
        empty mixture; columns other than key, text, lang and source are read only by ``domain``. A
        text counts with all its tokens, however long; one that does not fit ends the prefix before it.
        """
        scratch = Scratch.create(docs.sparkSession)
        rows = scratch.keep(self._rows(docs), "rows")
        return self._taken(rows, self.plan(rows, scratch)).select(
            F.col("key").alias(self.key), *LEVELS, "epoch", F.col("tokens").alias("n_tokens")
        )

    def mixed(self, docs: DataFrame) -> DataFrame:
        """The documents themselves, all columns, a row for each time one is taken."""
        scratch = Scratch.create(docs.sparkSession)
        rows = scratch.keep(self._rows(docs), "rows")
        plan = self.plan(rows, scratch)
        whole = docs.select(
            F.struct(*docs.columns).alias("doc"),
            F.col(self.key).alias("key"),
            F.expr(self.domain).cast("string").alias("domain"),
            F.col("lang"),
            F.col("source"),
            words(F.col(self.text)).alias("tokens"),
        )
        return self._taken(whole, plan).select("doc.*")
