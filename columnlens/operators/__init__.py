"""Operators: DataFrame in, DataFrame out."""

from .counts import (
    corpus_counts,
    count_cells,
    distinct_counts,
    empty_cells,
    frequent_values,
    typed_counts,
    value_counts,
)
from .keys import key_candidates
from .matching import contains_match, exact_match, fuzzy_match
from .resolve import resolve_columns, unresolved
from .stats import (
    date_stats,
    numeric_stats,
    text_extremes,
    text_lengths,
    text_stats,
    type_counts,
    typed_extremes,
)
from .tally import (
    empty_labels,
    filled_values,
    pattern_mentions,
    term_mentions,
    top_values,
    value_tally,
    without_numbers,
)

__all__ = [
    "contains_match", "corpus_counts", "count_cells", "date_stats", "distinct_counts",
    "empty_cells", "empty_labels", "exact_match", "filled_values", "frequent_values",
    "fuzzy_match", "key_candidates", "numeric_stats", "pattern_mentions",
    "resolve_columns", "term_mentions", "text_extremes", "text_lengths", "text_stats",
    "top_values", "type_counts", "typed_counts", "typed_extremes", "unresolved", "value_counts",
    "value_tally", "without_numbers",
]
