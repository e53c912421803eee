"""Column expressions shared by the queries (all JVM-side, codegen friendly)."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- rounding

def rnd(c, digits: int = 2) -> Column:
    """Round half away from zero on the decimal value of a double.

    Going through DECIMAL(38,6) first removes summation-order noise in the
    last bits, so two engines that add in different orders agree."""
    return F.round(col(c).cast("decimal(38,6)"), digits).cast("double")


def sql_rnd(expr: str, digits: int = 2) -> str:
    """The same rounding as SQL text (Spark and DuckDB)."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,6)), {digits}) AS DOUBLE)"


# ---------------------------------------------------------------- pricing

def disc_price(price="l_extendedprice", discount="l_discount") -> Column:
    """H3: price * (1 - discount); doubles throughout (H2)."""
    return col(price).cast("double") * (F.lit(1.0) - col(discount))


def charge(price="l_extendedprice", discount="l_discount", tax="l_tax") -> Column:
    """H3: price * (1 - discount) * (1 + tax)."""
    return disc_price(price, discount) * (F.lit(1.0) + col(tax))


# ---------------------------------------------------------------- dates

_LOOSE_DATE = re.compile(r"^\s*(\d{4})-(\d{1,2})-(\d{1,2})\s*$")


def parse_date(s: str | _dt.date) -> _dt.date:
    """Parse ``YYYY-M-D`` (zero padding optional) once, on the driver,
    into a literal; columns are parsed with :func:`parse_date_col`."""
    if isinstance(s, _dt.date):
        return s
    m = _LOOSE_DATE.match(s)
    if not m:
        raise ValueError(f"not a date: {s!r}")
    return _dt.date(int(m.group(1)), int(m.group(2)), int(m.group(3)))


def parse_date_col(c) -> Column:
    """H11 for a text column: padded or unpadded ISO dates, null if bad."""
    return F.try_to_timestamp(col(c), F.lit("y-M-d")).cast("date")


def add_months(d: str | _dt.date, months: int) -> _dt.date:
    """H10 on a literal: calendar month arithmetic (end of month clamps)."""
    d = parse_date(d)
    y, m = divmod(d.month - 1 + months, 12)
    y += d.year
    m += 1
    import calendar
    last = calendar.monthrange(y, m)[1]
    return _dt.date(y, m, min(d.day, last))


def add_years(d, years: int) -> _dt.date:
    return add_months(d, 12 * years)


def add_days(d, days: int) -> _dt.date:
    return parse_date(d) + _dt.timedelta(days=days)


def lit_date(d) -> Column:
    return F.lit(parse_date(d))


def in_range(c, lo, hi) -> Column:
    """Half-open [lo, hi) on a date/timestamp column; pushed to parquet."""
    return (col(c) >= lit_date(lo)) & (col(c) < lit_date(hi))


def year_of(c) -> Column:
    """H9 as BIGINT, the type both engines agree on."""
    return F.year(col(c)).cast("bigint")


# ---------------------------------------------------------------- text

def byte_length(c) -> Column:
    """H4: length of the UTF-8 bytes, not of characters."""
    return F.octet_length(col(c))


def starts_with_flag(c, prefix: str) -> Column:
    """1 when the text starts with ``prefix`` else 0."""
    return col(c).startswith(prefix).cast("int")


def parse_typed(c, dtype: str) -> Column:
    """Empty text is null, anything else must parse (ANSI cast raises)."""
    return F.nullif(col(c), F.lit("")).cast(dtype)


def try_parse_typed(c, dtype: str) -> Column:
    """H14 lossy form: a bad value becomes null instead of failing."""
    return F.nullif(col(c), F.lit("")).try_cast(dtype)


def row_hash(*cols) -> Column:
    """64-bit hash of one or several columns (floats hash too)."""
    return F.xxhash64(*[col(c) for c in cols])


def safe_div(a, b) -> Column:
    """H1/D15 division that yields null on a zero or null divisor."""
    return F.try_divide(col(a), col(b))
