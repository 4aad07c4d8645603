"""Readers and writers.  Everything read is a DataFrame, everything written a directory."""

from .documents import (
    combine_json,
    profile_json,
    read_profiles,
    write_keys,
    write_labels,
    write_metrics,
    write_profiles,
    write_semantic,
)
from .lists import (
    parse_abbrev_terms,
    parse_terms,
    parse_truth,
    parse_worklist,
    read_terms,
    read_terms_with_abbrev,
    read_truth,
    read_worklist,
)
from .split import read_split_table
from .tables import parse_catalog, read_catalog, read_table, table_headers

__all__ = [
    "combine_json", "parse_abbrev_terms", "parse_catalog", "parse_terms", "parse_truth",
    "parse_worklist", "profile_json", "read_catalog", "read_profiles", "read_table",
    "read_terms", "read_terms_with_abbrev", "read_truth", "read_worklist",
    "read_split_table", "table_headers", "write_keys", "write_labels", "write_metrics", "write_profiles", "write_semantic",
]
