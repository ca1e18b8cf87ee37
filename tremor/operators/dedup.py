"""Latest revision per key.

``row_number() = 1`` over ``partition by key order by ...`` is the shape
Catalyst recognises as a group limit: it plans a partial
``WindowGroupLimit`` *before* the shuffle, so each map task sends at most
one row per key. A key that holds a third of all rows therefore costs one
row per map task in the exchange, not a third of the data in one task.

The order must be total, or the survivor depends on input layout; callers
pass tiebreak columns after the primary order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK_COL = "__rn"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RANK_COL, F.row_number().over(w)).filter(F.col(RANK_COL) == 1).drop(RANK_COL)
