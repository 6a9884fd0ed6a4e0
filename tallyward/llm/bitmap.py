"""A bitmap of fixed size that tells which rows cannot have a wanted key."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 23  # one megabyte, whatever the number of keys
WORDS = 1 << (BITS - 6)


def maybe_wanted(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` less most of those whose 64-bit hash ``key`` is not in ``wanted``.

    What stays is to be joined with ``wanted``. It spares the join the shuffle of rows without a
    partner.
    """
    return rows.filter(key_test(wanted, key)(key))


def key_test(wanted: DataFrame, key: str) -> Callable[[str], Column]:
    """A test whether a 64-bit hash may be among the ``key`` of ``wanted``.

    The bitmap lets strangers through, the more the fuller it is, but is never false for a wanted
    key.
    """
    places = F.explode(
        F.array(F.col(key).bitwiseAND((1 << BITS) - 1), F.shiftrightunsigned(key, 64 - BITS))
    )
    words = (
        wanted.select(places.alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(place % 64 AS INT))")).alias("bits"))
        .collect()  # one row per word of the bitmap at most
    )
    bitmap = np.zeros(WORDS, np.uint64)
    if words:
        bits = np.array([w["bits"] for w in words], np.int64)
        bitmap[[w["word"] for w in words]] = bits.view(np.uint64)
    shared = wanted.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def known(keys: pd.Series) -> pd.Series:
        value = keys.to_numpy(np.int64).view(np.uint64)
        found = np.ones(len(value), bool)
        for place in (value & np.uint64((1 << BITS) - 1), value >> np.uint64(64 - BITS)):
            word = shared.value[(place >> np.uint64(6)).astype(np.int64)]
            found &= (word >> (place & np.uint64(63))) & np.uint64(1) == 1
        return pd.Series(found)

    return known
