"""Generic DataFrame -> DataFrame operators the analyses are composed of."""

from roadlens.operators.aggregate import (
    count_by,
    count_entities,
    count_rows,
    having_count,
    limit_offset,
    rank_band,
    sum_having,
    top_k,
    top_k_by_count,
    top_k_by_measure,
)
from roadlens.operators.filtering import (
    distinct_matching,
    distinct_not_matching,
    drop_matching,
    drop_not_in,
    keep_matching,
    key_list,
    top_n_filter,
    top_values,
)
from roadlens.operators.hot_keys import hot_marks, salted_semi_join, split_join
from roadlens.operators.setops import except_rows
from roadlens.operators.window import first_per_key, top_1_per_group

__all__ = [
    "count_by", "count_entities", "count_rows", "distinct_matching", "distinct_not_matching",
    "drop_matching", "drop_not_in", "except_rows", "first_per_key", "having_count", "hot_marks", "keep_matching",
    "key_list", "limit_offset", "rank_band", "salted_semi_join", "split_join", "sum_having", "top_1_per_group", "top_k", "top_k_by_count",
    "top_k_by_measure", "top_n_filter", "top_values",
]
