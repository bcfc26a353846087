"""Column expressions for text cleaning and numeric coercion.

All of these are built-in Spark expressions (JVM side, inside whole-stage
codegen); none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must equal the source data's conventions for identical results).
# Placeholder texts that mean "no value", compared after lower-casing and trimming.
PLACEHOLDERS = ("unknown", "not applicable", "unk", "none", "nan", "")
# Further texts treated as missing across the whole table.
EXTRA_NULL_TOKENS = ("<na>", "nan")

# Numeric text: optional sign, digits with optional fraction (or a bare
# fraction), optional exponent. Spark alone would also accept '1d' or '1f'.
NUMERIC_PATTERN = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
# Whitespace stripped from both ends of text: space, tab, newline, vertical
# tab, form feed, carriage return.
WHITESPACE = " \t\n\u000b\f\r"


def strip_lower(c: Column) -> Column:
    """Lower-case and strip surrounding whitespace."""
    return F.lower(strip(c))


def strip(c: Column) -> Column:
    """Remove surrounding whitespace (``trim`` with an explicit character set)."""
    return F.trim(c, F.lit(WHITESPACE))


def null_if_in(c: Column, values) -> Column:
    """NULL when ``c`` is one of ``values``, else ``c``.

    ``c`` is read twice: where it is costly, name it in a projection before.
    """
    return F.when(~c.isin(*values), c)


def is_numeric_text(c: Column) -> Column:
    """True when the (already trimmed) text is a plain decimal number."""
    return F.regexp_like(c, F.lit(NUMERIC_PATTERN))


def to_number(c: Column, dtype: T.DataType) -> Column:
    """Coerce to double: numbers pass, numeric text converts, anything else is NULL.

    Integral inputs keep their type (as a columnar number parser would);
    floating inputs stay double.
    """
    if isinstance(dtype, T.StringType):
        trimmed = strip(c)
        return F.when(is_numeric_text(trimmed), trimmed.try_cast("double"))
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c
    return c.cast("double")


def is_bad_number(c: Column, dtype: T.DataType) -> Column:
    """Value present but not numeric (only text can be bad)."""
    if isinstance(dtype, T.StringType):
        trimmed = strip(c)
        return c.isNotNull() & ~is_numeric_text(trimmed)
    return F.lit(False)
