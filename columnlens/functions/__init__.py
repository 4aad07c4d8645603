"""Column expressions: everything here builds a Column and starts no job."""

from .cells import is_empty, normalized
from .celltype import cell_type, parse_date, parse_double, parse_long, parsed_values
from .text import pattern_match, similarity, similarity_reach

__all__ = [
    "cell_type", "is_empty", "normalized", "parse_date", "parse_double",
    "parse_long", "parsed_values", "pattern_match", "similarity", "similarity_reach",
]
