"""Column expressions and domain rules."""

from curatio.functions.expr import (  # noqa: F401
    as_col,
    c,
    content_handle,
    empty_or_null,
    epoch_seconds,
    first_match,
    half_even,
    in_values,
    json_string_array,
    not_in_values,
    number_text,
    safe_ratio,
    start_of_day,
    strip_json_punct,
    to_number,
    years_since,
)
