"""Column functions: all of them build Catalyst expressions, none runs Python per row."""

from marlstone.functions.keys import UNKNOWN_SK, date_key, surrogate_key
from marlstone.functions.masks import mask_email, mask_tagged_pii, region_visible
from marlstone.functions.numbers import line_revenue, positive_price, safe_ratio
from marlstone.functions.text import code_lower, code_upper, tidy, title_case
from marlstone.functions.timestamps import MESSY_FORMATS, parse_in_order, parse_messy_timestamp

__all__ = [
    "MESSY_FORMATS", "UNKNOWN_SK", "code_lower", "code_upper", "date_key",
    "line_revenue", "mask_email", "mask_tagged_pii", "parse_in_order",
    "parse_messy_timestamp", "positive_price", "region_visible", "safe_ratio",
    "surrogate_key", "tidy", "title_case",
]
