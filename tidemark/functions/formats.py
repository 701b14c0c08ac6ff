"""Numbers and dates as texts for notes and tables. Null and NaN are a dash throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.stats import col, no_nan

# fixed values
DASH, MINUS, SIGMA = "\u2014", "\u2212", "\u03c3"


def _text(x: Column, digits: int, grouped: bool = True) -> Column:
    return F.format_string(f"%{',' if grouped else ''}.{digits}f", F.bround(x, digits))


def _or_dash(x: Column, text: Column) -> Column:
    return F.when(x.isNull(), DASH).otherwise(text)


def _number(c: Column | str, scale: float = 1.0) -> Column:
    return no_nan(col(c).cast("double")) * scale


def num(c: Column | str, digits: int = 2) -> Column:
    """1,234.50"""
    x = _number(c)
    return _or_dash(x, _text(x, digits))


def pct(c: Column | str, digits: int = 1) -> Column:
    """A share as a percentage: 12.5%"""
    x = _number(c, 100.0)
    return _or_dash(x, F.concat(_text(x, digits), F.lit("%")))


def bps(c: Column | str, digits: int = 0) -> Column:
    """Percentage points as basis points: 125 bps"""
    x = _number(c, 100.0)
    return _or_dash(x, F.concat(_text(x, digits), F.lit(" bps")))


def _sign(x: Column) -> Column:
    return F.when(x >= 0, "+").otherwise(MINUS)


def sigma(c: Column | str, digits: int = 1) -> Column:
    """A z with its sign: +1.5 and the letter sigma"""
    x = _number(c)
    return _or_dash(x, F.concat(_sign(x), _text(F.abs(x), digits, grouped=False), F.lit(SIGMA)))


def signed(c: Column | str, digits: int = 2) -> Column:
    """+1,234.50"""
    x = _number(c)
    return _or_dash(x, F.concat(_sign(x), _text(F.abs(x), digits)))


def day(c: Column | str) -> Column:
    """2024-01-31"""
    return F.coalesce(F.date_format(col(c), "yyyy-MM-dd"), F.lit(DASH))
