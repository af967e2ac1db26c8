from tidemark.functions.exprs import (  # noqa: F401
    as_of_literal,
    blank_as_absent,
    day_key,
    day_text,
    days_before,
    empty_floats,
    has_error,
    known_event_name,
    month_key,
    to_millis,
)
