from .aggregates import combine_on_key, count_rows, sum_per_key
from .expectations import (
    Rule,
    constraint_sql,
    expectation_report,
    guard,
    observe_rules,
    observe_stream,
    stream_counts,
    violations,
)
from .flatten import explode_keep, explode_only, items_as_rows, promote_struct
from .lookups import keep_matching, matching_batch, snapshot
from .ranking import first_per_key, summarise_per_key, top_k, with_key_stats

__all__ = [
    "Rule",
    "combine_on_key",
    "constraint_sql",
    "count_rows",
    "expectation_report",
    "explode_keep",
    "explode_only",
    "first_per_key",
    "guard",
    "items_as_rows",
    "keep_matching",
    "matching_batch",
    "observe_rules",
    "observe_stream",
    "promote_struct",
    "snapshot",
    "stream_counts",
    "sum_per_key",
    "summarise_per_key",
    "top_k",
    "violations",
    "with_key_stats",
]
