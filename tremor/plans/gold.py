"""Silver -> Gold star schema (four dimensions and one fact).

``gold(silver)`` is pure; ``tremor.plans.runs.run_gold`` reads a written
Silver (so the dimensions and the fact never re-evaluate the Silver
lineage), writes the dimensions first and the fact last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import dims as dims_mod
from ..operators import fact as fact_mod

TABLE_ORDER = ["dim_date", "dim_location", "dim_magnitude", "dim_event_type", "fact_earthquake_events"]


def gold(silver: DataFrame, null_safe: bool = False, with_clock: bool = True, drop_duplicate_events: bool = True) -> dict[str, DataFrame]:
    tables = dims_mod.all_dims(silver)
    tables["fact_earthquake_events"] = fact_mod.fact_events(
        silver, null_safe=null_safe, with_clock=with_clock, drop_duplicate_events=drop_duplicate_events
    )
    return tables
