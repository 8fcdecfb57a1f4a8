"""Blank tests, ratios, paths and other small text and number expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c, nan_text: bool = True) -> Column:
    """NULL or empty; with ``nan_text`` also the text ``nan`` a frame writer leaves for a gap.

    The column is named once only: a filter pushed down to a scan repeats every reference.
    """
    text = F.coalesce(column(c), F.lit(""))
    return text.isin("", "nan") if nan_text else text == ""


# The number texts that count as numbers.
WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"
REAL_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def whole_number(c, kind: str = "bigint") -> Column:
    """Text as an integer, NULL for other text.

    A failed ``try_cast`` costs some 15 microseconds a row, as it goes through an exception, so text
    is looked at before it is cast.
    """
    c = column(c)
    return F.when(c.rlike(WHOLE_NUMBER), c.try_cast(kind))


def real_number(c) -> Column:
    """Text as a double, NULL for other text."""
    c = column(c)
    return F.when(c.rlike(REAL_NUMBER), c.try_cast("double"))


# The white space taken off both ends of a label.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def stripped(c) -> Column:
    """Text without white space of any kind at its ends."""
    return F.trim(column(c), F.lit(WHITE_SPACE))


def ratio(part, whole) -> Column:
    """part / whole as a double, NULL when there is nothing to divide by."""
    return F.try_divide(column(part).cast("double"), column(whole).cast("double"))


def percent(part, whole) -> Column:
    """Share in percent with one decimal, NULL for an empty whole."""
    return F.round(F.try_divide(column(part).cast("double") * 100, column(whole).cast("double")), 1)


def from_template(template: str, **values) -> Column:
    """Fill ``{name}`` places of a path template with columns; an unknown name is an error."""
    pieces = re.split(r"\{(\w+)\}", template)
    unknown = [n for n in pieces[1::2] if n not in values]
    if unknown:
        raise KeyError(f"template names {unknown}, known are {sorted(values)}")
    parts = [column(values[p]) if i % 2 else F.lit(p) for i, p in enumerate(pieces) if p]
    return F.concat(*parts)


def file_stem(c) -> Column:
    """File name without directories and without its last suffix."""
    return F.regexp_replace(F.regexp_extract(column(c), r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def shorten(c, limit: int = 50) -> Column:
    """Cut a value longer than ``limit`` so that it ends in ``...`` and fits."""
    c = column(c)
    return F.when(F.length(c) > limit, F.concat(F.left(c, F.lit(limit - 3)), F.lit("..."))).otherwise(c)


def report_time() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
