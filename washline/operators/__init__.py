"""DataFrame operators."""

from washline.operators.clean import digits_only, parse_currency, strip_specials, trim_strings
from washline.operators.convert import to_bigint, to_double, to_text, to_timestamp_fmt
from washline.operators.losses import count_losses, losses_of
from washline.operators.missing import normalize_nulls
from washline.operators.profile import (
    apply_types,
    count_types,
    infer_types,
    merge_counts,
    profile_types,
)
from washline.operators.routing import (
    change_branches,
    hour_parity_rules,
    merge_branches,
    route,
    take_branch,
)
from washline.operators.row_checksum import row_checksum
from washline.operators.row_index import with_row_index

__all__ = [
    "apply_types",
    "change_branches",
    "count_losses",
    "count_types",
    "digits_only",
    "hour_parity_rules",
    "infer_types",
    "losses_of",
    "merge_branches",
    "merge_counts",
    "normalize_nulls",
    "parse_currency",
    "profile_types",
    "route",
    "row_checksum",
    "strip_specials",
    "take_branch",
    "to_bigint",
    "to_double",
    "to_text",
    "to_timestamp_fmt",
    "trim_strings",
    "with_row_index",
]
