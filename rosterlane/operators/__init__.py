"""Relational operators: DataFrame in, DataFrame out."""

from rosterlane.operators.aggregates import conditional_distinct, distinct_concat, marks_by_key
from rosterlane.operators.bitmaps import bitmap_counts, metric_bitmaps, number_keys
from rosterlane.operators.changes import table_changes
from rosterlane.operators.columns import (
    ensure_columns,
    questions_to_columns,
    rename_columns,
    stringify_all,
    union_ragged,
)
from rosterlane.operators.joins import (
    exists_flag,
    keep_matching,
    left_join,
    lookup_override,
    merge_suffixed,
)
from rosterlane.operators.ordered import fill_within_group, first_per_key, ranked_first
from rosterlane.operators.prefilter import prefiltered

__all__ = [
    "bitmap_counts",
    "conditional_distinct",
    "distinct_concat",
    "ensure_columns",
    "exists_flag",
    "fill_within_group",
    "first_per_key",
    "keep_matching",
    "left_join",
    "lookup_override",
    "marks_by_key",
    "merge_suffixed",
    "metric_bitmaps",
    "number_keys",
    "prefiltered",
    "questions_to_columns",
    "ranked_first",
    "rename_columns",
    "stringify_all",
    "table_changes",
    "union_ragged",
]
