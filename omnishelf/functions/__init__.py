from omnishelf.functions.keys import (
    key_text,
    norm_key,
    packed_id,
    surrogate_key,
    uni_trim,
    unpacked_id,
)
from omnishelf.functions.scalars import (
    blank_to_null,
    first_nonblank,
    first_token,
    has_text,
    json_first,
    label_from_flags,
    safe_date,
    safe_double,
    safe_long,
    safe_timestamp,
    split_csv,
    split_json,
    strip_number_suffix,
    strip_sheet_quotes,
    whole_number,
    zero_to_null,
)

__all__ = [
    "blank_to_null",
    "first_nonblank",
    "first_token",
    "has_text",
    "json_first",
    "key_text",
    "label_from_flags",
    "norm_key",
    "packed_id",
    "safe_date",
    "safe_double",
    "safe_long",
    "safe_timestamp",
    "split_csv",
    "split_json",
    "strip_number_suffix",
    "strip_sheet_quotes",
    "surrogate_key",
    "uni_trim",
    "unpacked_id",
    "whole_number",
    "zero_to_null",
]
