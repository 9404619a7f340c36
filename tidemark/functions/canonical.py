"""Canonical text of a value, and strict parsing back.

Nothing here depends on the session time zone, the locale or ANSI mode:
instants are rendered in UTC, and text that does not parse stops the job with
the column's name instead of turning into NULL.
"""

from __future__ import annotations

import re
from datetime import datetime
from decimal import Context, Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import TidemarkError, UnsupportedType
from tidemark.functions.numbers import decimal_text, float_text

# Words read as booleans, and the text written for them.
TRUE_WORDS = ("1", "true", "TRUE")
FALSE_WORDS = ("0", "false", "FALSE")
TRUE_TEXT = "1"
FALSE_TEXT = "0"

# Shapes of the canonical text forms, matched against the whole text.
DATE_SHAPE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}( 00:00:00(\.0{1,6})?)?"
TIMESTAMP_SHAPE = r"[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?"
ZONED_SHAPE = TIMESTAMP_SHAPE + r"( [+-][0-9]{2}:[0-9]{2})?"
INTEGER_SHAPE = r"[+-]?[0-9]+"
NUMBER_SHAPE = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
FLOAT_SHAPE = NUMBER_SHAPE + r"|[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?|[+-]?[nN][aA][nN]"
YEAR_MONTH_SHAPE = r"([+-])([0-9]{2,})-([0-9]{2})"
DAY_TIME_SHAPE = r"([+-])([0-9]{2,}) ([0-9]{2}):([0-9]{2}):([0-9]{2}\.[0-9]{6})"

_TEXT = T.StringType()
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)


def _is_text(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.CharType, T.VarcharType))


def check_supported(name: str, kind: T.DataType) -> None:
    scalar = (
        _INTEGRAL
        + _FLOATING
        + (
            T.DecimalType,
            T.BooleanType,
            T.BinaryType,
            T.DateType,
            T.TimestampType,
            T.TimestampNTZType,
            T.DayTimeIntervalType,
            T.YearMonthIntervalType,
        )
    )
    if not (_is_text(kind) or isinstance(kind, scalar)):
        raise UnsupportedType(f"column {name!r}: type {kind.simpleString()} has no canonical form")


def canonical_type(kind: T.DataType) -> T.DataType:
    """The type a column has after an extract: text, except floats, bytes and booleans."""
    if isinstance(kind, _FLOATING + (T.BinaryType, T.BooleanType)):
        return kind
    check_supported("?", kind)
    return _TEXT


# -- value to text ---------------------------------------------------------------


def _six_digit_fraction(text: Column) -> Column:
    whole = F.substring_index(text, ".", 1)
    fraction = F.when(F.contains(text, F.lit(".")), F.substring_index(text, ".", -1)).otherwise("")
    return F.concat(whole, F.lit("."), F.rpad(fraction, 6, "0"))


def utc_wall_clock(instant: Column) -> Column:
    """An instant as its UTC wall-clock time, whatever the session zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def _day_time_text(interval: Column) -> Column:
    zero = F.expr("INTERVAL '0 00:00:00' DAY TO SECOND")
    size = F.abs(interval.cast("interval day to second"))
    part = lambda unit: F.extract(F.lit(unit), size)
    micros = (part("SECOND") * 1_000_000).cast("int")
    return F.format_string(
        "%s%02d %02d:%02d:%02d.%06d",
        F.when(interval < zero, "-").otherwise("+"),
        part("DAY"),
        part("HOUR"),
        part("MINUTE"),
        (micros / 1_000_000).cast("int"),
        micros % 1_000_000,
    )


def _year_month_text(interval: Column) -> Column:
    zero = F.expr("INTERVAL '0-0' YEAR TO MONTH")
    size = F.abs(interval.cast("interval year to month"))
    return F.format_string(
        "%s%02d-%02d",
        F.when(interval < zero, "-").otherwise("+"),
        F.extract(F.lit("YEAR"), size),
        F.extract(F.lit("MONTH"), size),
    )


def to_text(value: Column, kind: T.DataType, name: str = "?") -> Column:
    """The canonical text of any supported value except bytes."""
    check_supported(name, kind)
    if _is_text(kind):
        return value
    if isinstance(kind, _INTEGRAL):
        return value.cast("string")
    if isinstance(kind, T.DecimalType):
        return decimal_text(value, kind.scale)
    if isinstance(kind, _FLOATING):
        return float_text(value)
    if isinstance(kind, T.BooleanType):
        return F.when(value, TRUE_TEXT).when(~value, FALSE_TEXT)
    if isinstance(kind, T.DateType):
        return F.concat(value.cast("string"), F.lit(" 00:00:00"))
    if isinstance(kind, T.TimestampNTZType):
        return _six_digit_fraction(value.cast("string"))
    if isinstance(kind, T.TimestampType):
        return F.concat(
            _six_digit_fraction(utc_wall_clock(value).cast("string")), F.lit(" +00:00")
        )
    # format_string prints a missing argument as "null", so NULL is kept explicitly.
    if isinstance(kind, T.DayTimeIntervalType):
        return F.when(value.isNotNull(), _day_time_text(value))
    if isinstance(kind, T.YearMonthIntervalType):
        return F.when(value.isNotNull(), _year_month_text(value))
    raise UnsupportedType(f"column {name!r}: bytes have no text form")


def extract_value(value: Column, kind: T.DataType, name: str = "?") -> Column:
    """A value as an extract hands it out: text, except floats, bytes and booleans."""
    check_supported(name, kind)
    return value if canonical_type(kind) == kind else to_text(value, kind, name)


def load_value(value: Column, kind: T.DataType, name: str = "?") -> Column:
    """A value as a load receives it: text for everything except bytes."""
    return value if isinstance(kind, T.BinaryType) else to_text(value, kind, name)


def epoch_text(number: Column, unit: str) -> Column:
    """Milli- or microseconds since 1970 as UTC wall-clock text."""
    readers = {"ms": F.timestamp_millis, "us": F.timestamp_micros}
    if unit not in readers:
        raise UnsupportedType(f"epoch unit {unit!r}: use one of {sorted(readers)}")
    return _six_digit_fraction(utc_wall_clock(readers[unit](number)).cast("string"))


# -- text to value ---------------------------------------------------------------


def _is(text: Column, shape: str) -> Column:
    return text.rlike(rf"^(?:{shape})\z")


def _or_fail(parsed: Column, text: Column, kind: T.DataType, name: str) -> Column:
    message = F.concat(
        F.lit(f"column {name}: cannot read '"), text, F.lit(f"' as {kind.simpleString()}")
    )
    return F.coalesce(parsed, F.when(text.isNotNull(), F.raise_error(message).cast(kind)))


def _keeps_digits(text: Column, scale: int) -> Column:
    """Whether a number needs no more fraction digits than ``scale``.

    The digits it needs: those written after the point, less zeros at the end, less the exponent.
    """
    parts = r"^[+-]?([0-9]*)\.?([0-9]*)(?:[eE]([+-]?[0-9]+))?"
    whole, fraction, power = (F.regexp_extract(text, parts, i) for i in (1, 2, 3))
    digits = F.concat(whole, fraction)
    used = F.rtrim(digits, F.lit("0"))
    exponent = F.when(power == "", 0).otherwise(power.try_cast("int"))
    needed = F.length(fraction) - (F.length(digits) - F.length(used)) - exponent.cast("long")
    return (F.ltrim(used, F.lit("0")) == "") | (needed <= scale)


def _interval_from(text: Column, kind: T.DataType) -> Column:
    def group(shape: str, index: int, cast: str) -> Column:
        return F.regexp_extract(text, shape, index).try_cast(cast)

    if isinstance(kind, T.DayTimeIntervalType):
        shape = DAY_TIME_SHAPE
        size = F.make_dt_interval(
            group(shape, 2, "int"),
            group(shape, 3, "int"),
            group(shape, 4, "int"),
            group(shape, 5, "decimal(18,6)"),
        )
    else:
        shape = YEAR_MONTH_SHAPE
        size = F.make_ym_interval(group(shape, 2, "int"), group(shape, 3, "int"))
    signed = F.when(F.startswith(text, F.lit("-")), -size).otherwise(size)
    return F.when(_is(text, shape), signed).cast(kind)


def from_text(text: Column, kind: T.DataType, name: str = "?") -> Column:
    """Canonical text as a value of ``kind``; unreadable text, or a number with more
    fraction digits than a decimal has, fails the job."""
    check_supported(name, kind)
    if _is_text(kind):
        return text
    if isinstance(kind, T.BinaryType):
        return F.encode(text, "UTF-8")
    if isinstance(kind, T.BooleanType):
        parsed = F.when(text.isin(*TRUE_WORDS), True).when(text.isin(*FALSE_WORDS), False)
    elif isinstance(kind, _INTEGRAL):
        parsed = F.when(_is(text, INTEGER_SHAPE), text.try_cast(kind))
    elif isinstance(kind, T.DecimalType):
        fits = _is(text, NUMBER_SHAPE) & _keeps_digits(text, kind.scale)
        parsed = F.when(fits, text.try_cast(kind))
    elif isinstance(kind, _FLOATING):
        parsed = F.when(_is(text, FLOAT_SHAPE), text.try_cast(kind))
    elif isinstance(kind, T.DateType):
        parsed = F.when(_is(text, DATE_SHAPE), F.substring(text, 1, 10).try_cast(kind))
    elif isinstance(kind, T.TimestampNTZType):
        parsed = F.when(_is(text, TIMESTAMP_SHAPE), text.try_cast(kind))
    elif isinstance(kind, T.TimestampType):
        zoned = F.when(F.substring(text, -6, 1).isin("+", "-"), text).otherwise(
            F.concat(text, F.lit(" +00:00"))
        )
        parsed = F.when(_is(text, ZONED_SHAPE), zoned.try_cast(kind))
    else:
        parsed = _interval_from(text, kind)
    return _or_fail(parsed, text, kind, name)


_WIDER = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4}


def to_type(value: Column, have: T.DataType, want: T.DataType, name: str = "?") -> Column:
    """A value converted by the *target's* type, by way of its canonical text.

    Same types and widening integers stay native; everything else goes through
    the text form, so a value that does not fit fails instead of being changed.
    """
    check_supported(name, have)
    check_supported(name, want)
    if have == want or (_is_text(have) and _is_text(want)):
        return value
    if type(have) in _WIDER and type(want) in _WIDER and _WIDER[type(have)] <= _WIDER[type(want)]:
        return value.cast(want)
    if isinstance(have, T.BinaryType):
        raise UnsupportedType(f"column {name!r}: bytes do not load into {want.simpleString()}")
    if isinstance(have, T.DateType) and isinstance(want, T.TimestampNTZType):
        return value.cast(want)
    text = to_text(value, have, name)
    if isinstance(have, T.TimestampType) and isinstance(want, T.TimestampNTZType):
        text = F.substring_index(text, " +00:00", 1)
    return from_text(text, want, name)


# -- literals --------------------------------------------------------------------


def typed_literal(text: str, kind: T.DataType, name: str = "?") -> Column:
    """Watermark text as a literal of the cursor's own type, checked at once.

    The result is constant-folded, so a comparison with the bare cursor column
    reaches the Parquet or JDBC scan as a pushed filter.
    """

    def fits(shape: str) -> bool:
        return re.fullmatch(shape, text) is not None

    ok = True
    literal = F.lit(text)
    if isinstance(kind, _INTEGRAL):
        bits = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}[type(kind)]
        ok = fits(INTEGER_SHAPE) and -(1 << bits - 1) <= int(text) < 1 << bits - 1
    elif isinstance(kind, T.DecimalType):
        # A bound that does not fit the cursor's scale would be rounded past rows.
        ok = fits(NUMBER_SHAPE) and _fits_decimal(Decimal(text), kind)
    elif isinstance(kind, _FLOATING):
        ok = fits(FLOAT_SHAPE)
        literal = F.lit(float(text)) if ok else literal
    elif isinstance(kind, (T.DateType, T.TimestampNTZType)):
        ok = fits(DATE_SHAPE) or (fits(TIMESTAMP_SHAPE) and not isinstance(kind, T.DateType))
        ok = ok and _is_real_date(text)
        literal = F.lit(text[:10] if isinstance(kind, T.DateType) else text)
    elif isinstance(kind, T.TimestampType):
        ok = fits(ZONED_SHAPE) and _is_real_date(text)
        literal = F.lit(text if text[-6] in "+-" else f"{text} +00:00") if ok else literal
    elif not _is_text(kind):
        raise UnsupportedType(f"column {name!r}: {kind.simpleString()} cannot be a cursor")
    if not ok:
        raise TidemarkError(f"column {name}: cannot read '{text}' as {kind.simpleString()}")
    return literal if _is_text(kind) else literal.cast(kind)


def _fits_decimal(number: Decimal, kind: T.DecimalType) -> bool:
    scaled = number.scaleb(kind.scale, Context(prec=80))
    return scaled == scaled.to_integral_value() and abs(scaled) < 10**kind.precision


def _is_real_date(text: str) -> bool:
    try:
        datetime.strptime(text[:19], "%Y-%m-%d %H:%M:%S" if len(text) > 10 else "%Y-%m-%d")
    except ValueError:
        return False
    return True
