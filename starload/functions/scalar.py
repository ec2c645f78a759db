"""Scalar column helpers: null fills, casts, dates, flags, text.

All of them compose built-in expressions.  Typed literals are used for every
fill so a decimal column never widens to double and a date column never
receives a string (both happen silently with ``na.fill`` on mixed types).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

# Fixed values of the warehouse conventions.
NA_TEXT = "N/A"            # fill for missing text attributes
MIN_DATE = "1900-01-01"    # fill for missing dates
UNKNOWN_SK = -1            # surrogate key of the unknown member


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fill_text(c: str | Column, value: str = NA_TEXT) -> Column:
    """Replace null text with a constant."""
    return F.coalesce(_col(c), F.lit(value))


def fill_zero(c: str | Column, data_type: DataType | str | None = None) -> Column:
    """Replace a null number by zero of the column's own type."""
    zero = F.lit(0)
    if data_type is not None:
        zero = zero.cast(data_type)
    out = F.coalesce(_col(c), zero)
    return out.cast(data_type) if data_type is not None else out


def fill_min_date(c: str | Column, value: str = MIN_DATE) -> Column:
    """Null date (or timestamp truncated to a date) -> 1900-01-01, typed."""
    return F.coalesce(F.to_date(_col(c)), F.lit(value).cast("date"))


def cast_decimal(c: str | Column, precision: int = 10, scale: int = 2) -> Column:
    """Strict cast to decimal; under ANSI mode an overflow raises."""
    return _col(c).cast(DecimalType(precision, scale))


def cast_strict(c: str | Column, data_type: DataType | str) -> Column:
    """Strict cast; invalid text raises under ANSI mode."""
    return _col(c).cast(data_type)


def cast_try_default(c: str | Column, data_type: DataType | str, default) -> Column:
    """Risky cast -> typed default when the value does not convert."""
    if not isinstance(data_type, str):
        data_type = data_type.simpleString()
    return F.coalesce(_col(c).try_cast(data_type), F.lit(default).cast(data_type))


def parse_date(c: str | Column, fmt: str | None = None) -> Column:
    """Text -> DATE; text that does not match the format gives null."""
    if fmt is None:
        return F.to_date(_col(c))
    return F.try_to_date(_col(c), fmt)


def to_date_key(c: str | Column) -> Column:
    """The join key of a date lookup (timestamp or text -> DATE)."""
    return F.to_date(_col(c))


def flag_decode(c: str | Column, true_values: Iterable[str] = ("Y",)) -> Column:
    """Coded flag -> boolean; null stays null."""
    values = list(true_values)
    col = _col(c)
    return col == F.lit(values[0]) if len(values) == 1 else col.isin(values)


def split_array(c: str | Column, delimiter: str = ",") -> Column:
    """Delimited text -> array<string> (delimiter is a regex in Spark)."""
    return F.split(_col(c), delimiter)


def iso_text(c: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """date/timestamp -> ISO text."""
    return F.date_format(_col(c), fmt)


def ci_equals(c: str | Column, value: str) -> Column:
    """Case-insensitive equality, UPPER on both sides."""
    return F.upper(_col(c)) == F.upper(F.lit(value))


def load_timestamp(load_ts: str | None) -> Column:
    """Audit timestamp.  A given ``load_ts`` makes reruns repeatable
    (TIMESTAMP_NTZ literal); ``None`` means the query start time."""
    if load_ts is None:
        return F.current_timestamp()
    return F.lit(load_ts).cast("timestamp_ntz")
