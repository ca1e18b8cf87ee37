"""tremor: a Spark-native seismic-event lakehouse.

Public entry points (see README.md for the full layout):

* ``silver(flat)`` / ``gold(silver)``: the pure Bronze -> Silver and Silver -> Gold plans.
* ``read_documents``, ``flatten``, ``with_batch_ts``: the Bronze source.
* ``run_silver``, ``merge_silver``, ``run_gold``, ``run_all``: the jobs, with observed metrics.
* ``append_history``, ``compact_silver``: incremental processing with Structured Streaming.
"""

from .plans.gold import gold
from .plans.jobs import merge_silver, run_all, run_gold, run_silver
from .plans.silver import silver
from .sources.bronze import flatten, read_documents, with_batch_ts
from .streaming.incremental import append_history, compact_silver

__all__ = [
    "append_history",
    "compact_silver",
    "flatten",
    "gold",
    "merge_silver",
    "read_documents",
    "run_all",
    "run_gold",
    "run_silver",
    "silver",
    "with_batch_ts",
]
