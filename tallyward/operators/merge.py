"""Changes by key: rows that replace, add to and remove from a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_changes(changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the one that sorts last by ``order``, then by all other columns.

    An aggregate, so that a key with very many changes costs a task one row. Null is a key.
    """
    others = [c for c in [*order, *changes.columns] if c not in keys]
    others = list(dict.fromkeys(others))
    if not others:
        return changes.select(*keys).distinct()
    last = changes.groupBy(*keys).agg(F.max(F.struct(*others)).alias("_last"))
    return last.select(
        *[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in changes.columns]
    )


def upsert(
    before: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    delete: Column | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """``before`` after the changes: of equal keys the change's row counts, others stay or come in.

    Changes for which ``delete`` is true remove their key; null and false do not. Null keys are equal.
    Rows of ``before`` that repeat a key stay as they are unless a change has it. The columns are
    those of ``before``; changes may have more, for ``delete`` and ``order`` to look at.
    """
    last = last_changes(changes, keys, order)
    named = last.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & before[k].eqNullSafe(named[f"_key_{i}"])
    kept = before.join(named, same, "left_anti")
    if delete is not None:
        last = last.filter(~F.coalesce(delete, F.lit(False)))
    return kept.unionByName(last.select(*before.columns))
