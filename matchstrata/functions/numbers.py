"""Text-to-number coercion and guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import _col

# Decimal literal with optional blanks, sign, fraction and exponent. It keeps
# out what the JVM parser would also take: type suffixes, Infinity, NaN.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _as_double(c: Column) -> Column:
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def to_long(c: Column | str) -> Column:
    """Text to a whole number: '2', ' 3 ', '2.0', '1e2'; anything else, fractions too, is NULL.

    Loads tell fractions apart by :func:`not_integral`.
    """
    c = _col(c).cast("string")
    number = _as_double(c)
    whole = F.when(number == F.floor(number).cast("double"), number)
    exact = F.when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), c.try_cast("bigint"))
    return F.coalesce(exact, whole.try_cast("bigint"))


def not_integral(c: Column | str) -> Column:
    """Whether the text is a number that no whole number equals."""
    c = _col(c).cast("string")
    number = _as_double(c)
    exact = c.try_cast("bigint").isNotNull() | (
        (number == F.floor(number).cast("double")) & number.try_cast("bigint").isNotNull()
    )
    return F.coalesce(number.isNotNull() & ~F.coalesce(exact, F.lit(False)), F.lit(False))


def guarded_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as a double, 0 where the denominator is 0 or NULL."""
    return F.coalesce(F.try_divide(_col(numerator), _col(denominator)), F.lit(0.0))
