"""Whole analyses, put together from operators."""

from .batches import run_each
from .evaluate import (
    column_precision,
    correct_counts,
    distinct_worklist,
    label_counts,
    label_lines,
    manual_labels,
    precision_recall,
    predicted_counts,
    predicted_types,
    unmatched_labels,
)
from .jobs import find_keys, label_columns, profile_datasets, report
from .profile import profile, profile_corpus, profile_counts, profile_rows
from .semantic import (
    Rule,
    RuleSet,
    classify,
    default_rules,
    semantic_profile,
    semantic_types,
    term_table,
)

__all__ = [
    "Rule", "RuleSet", "classify", "column_precision", "correct_counts",
    "default_rules", "distinct_worklist", "find_keys", "label_columns", "label_counts",
    "label_lines", "manual_labels", "precision_recall", "predicted_counts", "predicted_types", "profile",
    "profile_corpus", "profile_counts", "profile_datasets", "profile_rows", "report", "run_each", "semantic_profile",
    "semantic_types", "term_table", "unmatched_labels",
]
