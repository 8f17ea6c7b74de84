"""Operators: DataFrame in, DataFrame out."""

from martkit.operators.delta import (
    apply_inserts,
    classify_delta,
    delta_inserts,
    delta_matched,
    delta_updates,
    upsert_snapshot,
)
from martkit.operators.fingerprint import compare_tables, fingerprint, table_digest
from martkit.operators.marts import dim_average, flagged_counts, orphan_counts, visit_counts
from martkit.operators.positions import with_positions
from martkit.operators.pruning import Pruning, narrow
from martkit.operators.quality import null_profile, readback_check
from martkit.operators.ranking import rank_within
from martkit.operators.rollup import Rollup, rollup
from martkit.operators.sizing import BroadcastPolicy, decide, decide_many, dimension, fits_broadcast

__all__ = [
    "BroadcastPolicy",
    "Pruning",
    "Rollup",
    "apply_inserts",
    "classify_delta",
    "compare_tables",
    "decide",
    "decide_many",
    "delta_inserts",
    "delta_matched",
    "delta_updates",
    "dim_average",
    "dimension",
    "fingerprint",
    "fits_broadcast",
    "flagged_counts",
    "narrow",
    "null_profile",
    "orphan_counts",
    "rank_within",
    "readback_check",
    "rollup",
    "table_digest",
    "upsert_snapshot",
    "visit_counts",
    "with_positions",
]
