from .compat import (  # noqa: F401
    any_of,
    as_column,
    day_first_to_iso,
    glob_regex,
    is_blank,
    is_true,
    like_ignoring_case,
    local_now,
    matches_glob,
    ratio,
    read_date,
    read_timestamp,
    rounded,
    text_length,
    whole_number,
    whole_number_or_null,
)
