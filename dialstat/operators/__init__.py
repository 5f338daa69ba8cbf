"""Table operators: DataFrame in, DataFrame out, no session inside."""

from dialstat.operators.aggregate import (
    distinct_values,
    join_aggregates,
    ratio_of_sums,
    row_counts,
    sums_by,
)
from dialstat.operators.keyfilter import key_filter, may_match
from dialstat.operators.lookup import broadcast_if_small, lookup
from dialstat.operators.quality import (
    Gate,
    GateError,
    check,
    duplicate_keys,
    require_non_empty,
    violation_counts,
)
from dialstat.operators.ranking import ordering, top_k, top_n_per_group

__all__ = [
    "Gate",
    "broadcast_if_small",
    "key_filter",
    "may_match",
    "GateError",
    "check",
    "distinct_values",
    "duplicate_keys",
    "join_aggregates",
    "lookup",
    "ordering",
    "ratio_of_sums",
    "require_non_empty",
    "row_counts",
    "sums_by",
    "top_k",
    "top_n_per_group",
    "violation_counts",
]
