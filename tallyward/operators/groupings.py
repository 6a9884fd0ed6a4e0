"""Several groupings of one table in one pass: sets, subtotals, cubes and cross tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grouped_sets(
    rows: DataFrame,
    sets: Sequence[Sequence[str]],
    measures: Mapping[str, Column],
) -> DataFrame:
    """One row per set and values of its columns, with the ``measures`` (aggregates).

    ``all_<column>`` is 1 where the column is not part of the row's set, so a subtotal is told from a
    null value. Spark expands each row once per set and combines before the shuffle: a hot value costs
    one row per task. A set that is listed twice gives its rows twice. The grand total of an empty
    table is one row, other sets of it have none.
    """
    columns = list(dict.fromkeys(c for s in sets for c in s))
    known = {c: F.col(f"`{c}`") for c in columns}
    return rows.groupingSets(
        [[known[c] for c in s] for s in sets], *known.values()
    ).agg(
        *[F.grouping(known[c]).cast("int").alias(f"all_{c}") for c in columns],
        *[m.alias(n) for n, m in measures.items()],
    )


def cube_sets(columns: Sequence[str]) -> list[list[str]]:
    """All subsets of the columns, the largest first."""
    return [list(s) for n in range(len(columns), -1, -1) for s in combinations(columns, n)]


def rollup_sets(columns: Sequence[str]) -> list[list[str]]:
    """The columns, then without the last, down to none."""
    return [list(columns[:n]) for n in range(len(columns), -1, -1)]


def cross_table(
    rows: DataFrame, by: Sequence[str], across: str, values: Sequence[str], count: str = "n"
) -> DataFrame:
    """Rows per ``by`` and value of ``across``, a column each: ``n_<value>``, ``n_null``, ``n_other``.

    The values are given, so the table needs no look at the data first and has the same columns for
    every input. Values that are not listed are counted as others.
    """
    column = F.col(f"`{across}`")
    named = {v: F.count_if(column.eqNullSafe(v)) for v in values}
    return rows.groupBy(*by).agg(
        *[c.alias(f"{count}_{v}") for v, c in named.items()],
        F.count_if(column.isNull()).alias(f"{count}_null"),
        F.count_if(column.isNotNull() & ~column.isin(*values)).alias(f"{count}_other"),
    )
