"""Scalar functions (Column -> Column) on Spark's built-in expressions."""

from .codes import (effective_class, highest_priority, node_category, parse_date,
                    token_count, transition_category, yes_no_flag)
from .numeric import marker_size, quota, round_half_even, safe_div
from .text import (clean_text, collapse_ws, has_any, has_literal, recode, strip_tabs,
                   title_case, utrim)

__all__ = [
    "clean_text", "collapse_ws", "effective_class", "has_any", "has_literal", "highest_priority",
    "marker_size", "node_category", "parse_date", "quota", "recode", "round_half_even", "safe_div",
    "strip_tabs", "title_case", "token_count", "transition_category", "utrim", "yes_no_flag",
]
