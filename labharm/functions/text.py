"""Texts for reports: numbers, markup and spreadsheet formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(x: str | Column) -> Column:
    """A number as text in its shortest digits, without exponent and trailing zeros: 500, 0.25, 0.000000001. Of less than 1e-18 nothing is left; from 1e20 on the exponent stays."""
    x = (F.col(x) if isinstance(x, str) else x).cast("double")
    plain = x.cast("string").try_cast("decimal(38,18)").cast("string")
    return F.coalesce(F.regexp_replace(F.regexp_replace(plain, r"\.?0+$", ""), "^-0$", "0"), x.cast("string"))


def escaped(x: str | Column) -> Column:
    """Text for an HTML attribute: quotes as character references."""
    x = F.col(x) if isinstance(x, str) else x
    return F.replace(F.replace(x, F.lit('"'), F.lit("&quot;")), F.lit("'"), F.lit("&#39;"))


def hyperlink(address: Column, lines: list[Column]) -> Column:
    """A spreadsheet formula that shows lines and leads to an address; quotes are doubled."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c.cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))
    return F.concat(F.lit("=HYPERLINK("), quoted(address), F.lit(", "), F.concat_ws("&CHAR(10)&", *map(quoted, lines)), F.lit(")"))
