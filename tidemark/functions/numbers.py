"""Numbers as plain text: ``.`` mark, no exponent, no padding zeros.

``7.0 -> 7``, ``1.0E10 -> 10000000000``, ``1.0E-5 -> 0.00001``. Works on the
digits of Spark's own text form, so it is exact over the whole double range
and never goes through a fixed decimal scale. The expressions are kept short:
the JVM does not compile generated code of more than 8000 bytes per method, and
a wide projection is one method.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fraction digits that leave nothing out. A double written with a positive exponent is
# at least 1e7 and has 17 digits; the smallest double is 4.9E-324.
_LARGE_FORMAT = "%.10f"
_SMALL_FORMAT = "%.340f"


def _strip_zeros(text: Column) -> Column:
    return F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))


def float_text(number: Column) -> Column:
    """Plain text of a float or double column; ``NaN``, ``inf`` and ``-inf`` as such."""
    text = number.cast("string")
    pattern = F.when(F.contains(text, F.lit("E-")), _SMALL_FORMAT).otherwise(_LARGE_FORMAT)
    # The text again as a double, so that a float keeps its own digits.
    written_out = F.call_function("format_string", pattern, text.try_cast("double"))
    return (
        F.when(F.endswith(text, F.lit(".0")), F.substring_index(text, ".", 1))
        .when(F.contains(text, F.lit("E")), _strip_zeros(written_out))
        .otherwise(F.replace(text, F.lit("Infinity"), F.lit("inf")))
    )


def decimal_text(number: Column, scale: int) -> Column:
    """Plain text of a decimal column."""
    text = number.cast("string")
    if scale == 0:
        return text
    # Outside ANSI mode Spark writes decimals under 1e-6 with an exponent: 1.25E-7.
    digits = F.translate(F.substring_index(text, "E", 1), "-.", "")
    zeros = F.repeat(F.lit("0"), -F.substring_index(text, "E", -1).try_cast("int") - 1)
    sign = F.when(number < 0, "-0.").otherwise("0.")
    plain = F.when(F.contains(text, F.lit("E")), F.concat(sign, zeros, digits)).otherwise(text)
    return _strip_zeros(plain)
