"""Text expressions: normalisation, labels and number formats."""

from __future__ import annotations

import sys

from pyspark.sql import Column, functions as F

from ..schema import FINISHED_STATUSES

# Every code point Unicode and Python treat as blank; Spark's plain trim knows
# the space only.
BLANKS = "".join(chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace())


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalized(c: Column | str) -> Column:
    """Trimmed on both sides of any blank, upper case."""
    return F.upper(F.btrim(_col(c), F.lit(BLANKS)))


def finished(status: Column | str, statuses=FINISHED_STATUSES) -> Column:
    """Whether a status means the match was played; NULL counts as not."""
    return F.coalesce(normalized(status).isin(*statuses), F.lit(False))


def first_filled(*columns: Column | str) -> Column:
    """The first value that is neither NULL nor empty; the last one as it is."""
    *heads, last = [_col(c) for c in columns]
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in heads], last)


def signed(c: Column | str) -> Column:
    """A whole number with its sign: +3, -1, +0."""
    c = _col(c)
    return F.when(c.isNotNull(), F.format_string("%+d", c))


def one_decimal(c: Column | str) -> Column:
    """A double with one decimal, rounded on its exact binary value, ties to even.

    The JVM's ``%.1f`` rounds the shortest decimal text half up instead: 1.25
    would show as 1.3. ``20 * size - (2 * tenths + 1)``, split into products by
    powers of two, is free of rounding near a tie.
    """
    value = _col(c).cast("double")
    size = F.abs(value)
    tenths = F.floor(size * 10)
    middle = (tenths * 2 + 1).cast("double")
    above = (size * 16 - middle) + size * 4
    up = (above > 0) | ((above == 0) & (tenths % 2 == 1))
    rounded = tenths + up.cast("bigint")
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
    whole = F.floor(rounded / 10).cast("string")
    return F.concat(sign, whole, F.lit("."), (rounded % 10).cast("string"))


def thousands(c: Column | str) -> Column:
    """A whole number with thousands separators."""
    return F.format_number(_col(c), 0)


# Podium labels.
MEDALS = {1: "🥇", 2: "🥈", 3: "🥉"}


def podium(position: Column | str) -> Column:
    """A medal for the first three positions, the number as text after them."""
    position = _col(position)
    medals = F.create_map(*[F.lit(x) for pair in MEDALS.items() for x in pair])
    return F.coalesce(F.try_element_at(medals, position.cast("int")), position.cast("string"))
