"""Column-expression helpers.  Every helper returns a built-in Spark
``Column`` so it stays inside whole-stage codegen; none is a Python UDF."""

from starload.functions.scalar import (
    MIN_DATE,
    NA_TEXT,
    UNKNOWN_SK,
    cast_decimal,
    cast_strict,
    cast_try_default,
    ci_equals,
    fill_min_date,
    fill_text,
    fill_zero,
    flag_decode,
    iso_text,
    load_timestamp,
    parse_date,
    split_array,
    to_date_key,
)

__all__ = [
    "MIN_DATE", "NA_TEXT", "UNKNOWN_SK", "cast_decimal", "cast_strict",
    "cast_try_default", "ci_equals", "fill_min_date", "fill_text", "fill_zero",
    "flag_decode", "iso_text", "load_timestamp", "parse_date", "split_array",
    "to_date_key",
]
