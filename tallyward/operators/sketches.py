"""Stored states of distinct counts and quantiles, merged when they are read.

A state is small and of bounded size however many rows it has seen, and states of parts merge to the
state of the whole. So figures of any set of groups and months come from the stored states alone.

Distinct counts are HyperLogLog states of 2^`LOG_K` registers: the relative standard error is
1.04 / sqrt(2^LOG_K), 1.6 % at 12. Quantiles are KLL states: the rank of an answer is off by less than
about 1 % of all rows for `KLL_K` = 400 (99 % of the time), and exact while a group has few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_K, KLL_K = 12, 400


def states(
    rows: DataFrame, by: Sequence[str], distinct: str | None = None, amount: str | None = None
) -> DataFrame:
    """(by, n, distinct_state, amount_state) of each group; nulls are in ``n`` alone.

    Rows of a group are brought together first, since a state costs far more than a row. A large
    group stays in several parts, each of which is combined before the shuffle of states: a hot group
    costs one state per task.
    """
    found = [F.count("*").alias("n")]
    if distinct:
        found.append(F.hll_sketch_agg(distinct, LOG_K).alias("distinct_state"))
    if amount:
        found.append(F.kll_sketch_agg_double(F.col(amount).cast("double"), KLL_K).alias("amount_state"))
    together = rows.select(*dict.fromkeys([*by, *filter(None, [distinct, amount])])).hint("rebalance", *by)
    return together.groupBy(*by).agg(*found)


def merged(stored: DataFrame, by: Sequence[str]) -> DataFrame:
    """The states of coarser groups, from those of finer ones."""
    found = [F.sum("n").alias("n")]
    if "distinct_state" in stored.columns:
        found.append(F.hll_union_agg("distinct_state").alias("distinct_state"))
    if "amount_state" in stored.columns:
        found.append(F.kll_merge_agg_double("amount_state", KLL_K).alias("amount_state"))
    return stored.groupBy(*by).agg(*found)


def distinct_count(state: str = "distinct_state") -> Column:
    return F.hll_sketch_estimate(state)


def quantile(rank: float, state: str = "amount_state") -> Column:
    """Null for a group without amounts."""
    rows = F.kll_sketch_get_n_double(state)
    return F.when(rows > 0, F.kll_sketch_get_quantile_double(state, F.lit(rank)))
