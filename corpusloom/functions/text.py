"""String helpers with Python's semantics, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The 29 code points that Python's str.strip() removes.
WHITESPACE = "".join(
    chr(c)
    for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
              0x202F, 0x205F, 0x3000]
)


def strip(text: Column) -> Column:
    """``str.strip()``: remove Unicode whitespace at both ends."""
    return F.trim(text, F.lit(WHITESPACE))


def stripped_length(text: Column) -> Column:
    """``len(text.strip())`` in code points."""
    return F.length(strip(text))


def last_split(text: Column, mark: str) -> tuple[Column, Column]:
    """The parts left and right of the last ``mark`` (``str.rsplit(mark, 1)``)."""
    right = F.substring_index(text, mark, -1)
    left = F.left(text, F.length(text) - F.length(right) - F.lit(len(mark)))
    return left, right


def py_float(value: Column) -> Column:
    """``str()`` of a double: the fewest digits that tell it apart, plain from 1e-4 to below 1e16, else with an exponent.

    The digits are the JVM's. Java before 19 has about one double in a thousand, most of them
    beyond 1e17, whose last digit differs from Python's; the spelling still reads back as the same number.
    """
    value = value.cast("double")
    size, spelled = F.abs(value), value.cast("string")
    # The JVM may give a digit or two more than needed, but not where 15 digits (and a point) tell the number apart.
    width = F.length(F.substring_index(spelled, "E", 1))
    few = width <= 16
    tries = [F.format_string(f"%.{digits}e", value) for digits in (14, 15, 16)]
    shown = F.when(few | value.isNull(), spelled)
    for tried in tries[:2]:
        shown = shown.when(tried.cast("double") == value, tried)
    shown = shown.when(width <= 18, spelled).otherwise(tries[2])

    def finish(shown: Column) -> Column:
        # 17 digits before the point and 21 behind it hold every number that is spelled plainly.
        plain = F.regexp_replace(shown.cast("decimal(38,21)").cast("string"), r"(\.\d+?)0*$", "$1")
        power = F.regexp_replace(F.regexp_replace(shown, r"\.?0*[Ee]", "e"), r"e(\d)", "e+$1")
        power = F.regexp_replace(power, r"e-(\d)$", "e-0$1")
        return (
            F.when(F.isnan(value), F.lit("nan"))
            .when(value == float("inf"), F.lit("inf"))
            .when(value == float("-inf"), F.lit("-inf"))
            .when((size >= 1e-4) & (size < 1e16), plain)
            .otherwise(power)
        )

    # The JVM and Python agree on most numbers, and nothing is worked out for them. The rest goes through an array of
    # one, so that its digits are found once; written out, the code grows too large for the JVM to compile.
    same = few & (((size >= 1e-3) & (size < 1e7)) | (size == 0))
    return F.when(same, spelled).otherwise(F.get(F.transform(F.array(shown), finish), F.lit(0)))


def py_str(value: Column, dtype: T.DataType) -> Column:
    """``str(value)``: null is the word ``None``, booleans are ``True``/``False``, fractions are spelled as Python does.

    Nested values keep Spark's spelling. A float is shown as the double it equals.
    """
    if isinstance(dtype, T.BooleanType):
        shown = F.when(value, F.lit("True")).when(~value, F.lit("False"))
    elif isinstance(dtype, T.FractionalType) and not isinstance(dtype, T.DecimalType):
        shown = py_float(value)
    else:
        shown = value.cast("string")
    return F.coalesce(shown, F.lit("None"))


def truthy(value: Column, dtype: T.DataType) -> Column:
    """``bool(value)``, decided by the column's type; never null."""
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        test = value != ""
    elif isinstance(dtype, T.BooleanType):
        test = value
    elif isinstance(dtype, T.NumericType):
        test = value != 0
    elif isinstance(dtype, (T.ArrayType, T.MapType)):
        test = F.size(value) > 0
    elif isinstance(dtype, T.BinaryType):
        test = F.octet_length(value) > 0
    elif isinstance(dtype, T.NullType):
        return F.lit(False)
    else:
        test = value.isNotNull()
    return F.coalesce(test, F.lit(False))
