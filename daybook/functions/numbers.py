"""Text to number and back, with the rules of a web form's script."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that a script's trim removes, and its number formats.
WHITE_SPACE = r"[\s\u00a0\ufeff\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
DECIMAL_NUMBER = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|[+-]?Infinity"
RADIX_NUMBERS = {16: "0[xX]0*([0-9a-fA-F]+)", 8: "0[oO]0*([0-7]+)", 2: "0[bB]0*([01]+)"}
RADIX_DIGITS = {16: 16, 8: 21, 2: 64}


def trimmed(text: Column) -> Column:
    """Text without white space, tabs and line breaks at both ends."""
    return F.regexp_replace(text, f"^{WHITE_SPACE}+|{WHITE_SPACE}+$", "")


def is_blank(text: Column) -> Column:
    """True for text that holds white space only; NULL stays NULL."""
    return text.rlike(f"^{WHITE_SPACE}*$")


def to_number(text: Column) -> Column:
    """Text as double, NULL where it is not a number or blank.

    A plain cast also takes ``1d``, ``1f`` and ``NaN``; here the format decides.
    """
    decimal = F.regexp_extract(text, f"^{WHITE_SPACE}*({DECIMAL_NUMBER}){WHITE_SPACE}*$", 1)
    numbers = [F.nullif(decimal, F.lit("")).cast("double")]
    for radix, digits in RADIX_NUMBERS.items():
        found = F.regexp_extract(text, f"^{WHITE_SPACE}*{digits}{WHITE_SPACE}*$", 1)
        numbers.append(_of_digits(F.nullif(found, F.lit("")), radix))
    return F.coalesce(*numbers)


def _of_digits(digits: Column, radix: int) -> Column:
    """Digits of any count as double: the first 64 bits, and what further digits multiply."""
    first = F.conv(F.substring(digits, 1, RADIX_DIGITS[radix]), radix, 10).cast("double")
    further = F.greatest(F.length(digits) - RADIX_DIGITS[radix], F.lit(0))
    return first * F.pow(F.lit(float(radix)), further)


def is_number(text: Column) -> Column:
    """True where :func:`to_number` gives a value."""
    return to_number(text).isNotNull()


def fixed_decimals(value: Column, places: int = 4) -> Column:
    """A number as text with a fixed count of decimals; NULL stays NULL."""
    return F.when(value.isNotNull(), F.format_string(f"%.{places}f", value.cast("double")))


def number_text(value: Column) -> Column:
    """A number as a script writes it: no decimals for a whole number, and plain decimals
    from a millionth up to below 10 ** 21, beyond that an exponent."""
    size = F.abs(value.cast("double"))
    text = value.cast("string")
    small = F.format_number(text.try_cast("decimal(38,30)"), 30)
    large = F.format_number(text.try_cast("decimal(38,10)"), 10)
    digits = F.regexp_replace(F.when(size < 1, small).otherwise(large), ",", "")
    trimmed_zeros = F.regexp_replace(digits, r"\.?0+$", "")
    exponent = F.regexp_replace(F.regexp_replace(text, r"(?:\.0)?E-", "e-"), r"(?:\.0)?E(\d)", "e+$1")
    return (
        F.when(~text.contains("E"), F.regexp_replace(text, r"\.0$", ""))
        .when((size >= 1e-6) & (size < 1e21), trimmed_zeros)
        .otherwise(exponent)
    )


def integer_between(key: Column, low: int, high: int) -> Column:
    """An integer of the range, spread evenly over the keys and the same in every run."""
    digest = F.conv(F.substring(F.md5(key.cast("string")), 1, 12), 16, 10).cast("long")
    return (digest % (high - low + 1) + low).cast("int")


def random_integer(low: int, high: int, seed: int | None = None) -> Column:
    """An evenly distributed random integer of the range."""
    return (F.floor(F.rand(seed) * (high - low + 1)) + low).cast("int")
