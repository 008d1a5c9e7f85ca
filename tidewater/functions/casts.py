"""Lenient text casts (old, non-ANSI cast semantics without touching the session).

Raw zone tables hold every column as text.  The clean jobs cast with plain ``cast``,
which under the old default gave NULL on bad text; under ANSI it raises.  These
expressions stay NULL-on-bad-input under either setting and never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: text accepted as an integer; the fraction is cut, as the old cast did.
INT_TEXT_PATTERN = r"^([+-]?[0-9]+)([.][0-9]*)?$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_int_lenient(col: Column | str) -> Column:
    """Text -> int; NULL when not an integer literal or out of range; '1.5' -> 1."""
    return F.regexp_extract(F.trim(_c(col)), INT_TEXT_PATTERN, 1).try_cast("int")


def to_float_lenient(col: Column | str) -> Column:
    """Text -> 32-bit float; NULL when unparsable."""
    return _c(col).try_cast("float")


def to_ts_lenient(col: Column | str) -> Column:
    """Text -> session timestamp; NULL when unparsable (no format, like to_timestamp)."""
    return F.try_to_timestamp(_c(col))


def value_text(col: Column | str, dtype: T.DataType) -> Column:
    """Text of a value the way Python's ``str`` prints it after a fetch.

    Timestamps print seconds, and six fraction digits only when the fraction is not
    zero; strings print as they are; other types use Spark's cast to string.
    """
    c = _c(col)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        base = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        frac = F.date_format(c, "SSSSSS")
        return F.when(frac == F.lit("000000"), base).otherwise(F.concat(base, F.lit("."), frac))
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(dtype, T.StringType):
        return c
    return c.cast("string")


def partition_label(col: Column | str, dtype: T.DataType) -> Column:
    """``'ds=' + str(value)``; a NULL value gives ``ds=None``."""
    return F.concat(F.lit("ds="), F.coalesce(value_text(col, dtype), F.lit("None")))
