"""Scalar column expressions of the staging, mart and dashboard layers.

Every function takes and returns `Column`s and compiles to built-in Catalyst
expressions, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.schemas import CENTS, MONEY, WHOLE, WORK

__all__ = [
    "col_of", "strict_cast", "safe_cast", "int_to_bool", "cents_to_usd", "currency_text_to_usd",
    "ts_to_date", "safe_divide", "bid_ask_spread", "turnover_rate", "bid_ask_ratio",
    "money", "money_product", "case_label", "scale_pct", "to_double", "display_money",
    "display_fixed", "display_count", "kpi_number", "date_sub_days", "as_date",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_cast(c, to) -> Column:
    """Cast that fails the query on bad input (ANSI mode)."""
    return col_of(c).cast(to)


def safe_cast(c, to) -> Column:
    """Cast that yields NULL on bad input."""
    return col_of(c).try_cast(to)


def int_to_bool(c) -> Column:
    """0/1 integer flag to boolean (any non-zero is true)."""
    return col_of(c).cast(T.BooleanType())


def money(c) -> Column:
    """Store a money / ratio value as DECIMAL(38,9), rounding half away from zero."""
    return col_of(c).cast(MONEY)


def cents_to_usd(c) -> Column:
    """Integer cents to dollars: NUMERIC / 100, exact for every BIGINT."""
    return money(safe_cast(c, CENTS) / F.lit(100))


def currency_text_to_usd(c) -> Column:
    """Price text such as '$1,234.56' to NUMERIC.

    Every character other than digits and '.' is dropped, then a safe cast:
    '' and '1.2.3' become NULL, a sign is lost, comma decimals are mis-read
    (the same behaviour as the warehouse expression it replaces).
    """
    return safe_cast(F.regexp_replace(col_of(c), r"[^0-9.]", ""), MONEY)


def ts_to_date(c) -> Column:
    """Timestamp to its date in the session time zone (UTC)."""
    return F.to_date(col_of(c))


def safe_divide(a, b) -> Column:
    """NULL when the divisor is 0 or either side is NULL."""
    return F.try_divide(col_of(a), col_of(b))


def _either(exact: Column, wide: Column) -> Column:
    """The exact decimal result; where an input has more than 15 integer digits, the one by doubles."""
    return F.coalesce(money(exact), money(wide))


def bid_ask_spread(ask, bid) -> Column:
    """(ask - bid) / bid as a fraction, NUMERIC."""
    a, b = safe_cast(ask, WORK), safe_cast(bid, WORK)
    x, y = to_double(ask), to_double(bid)
    return _either(safe_divide(a - b, b), safe_divide(x - y, y))


def turnover_rate(units, asks) -> Column:
    """units sold / active asks as FLOAT64; NULL on zero asks."""
    return safe_divide(F.coalesce(col_of(units), F.lit(0)).cast("bigint"), col_of(asks).cast("bigint"))


def bid_ask_ratio(bid, ask) -> Column:
    """bid / ask, NUMERIC."""
    return _either(safe_divide(safe_cast(bid, WORK), safe_cast(ask, WORK)),
                   safe_divide(to_double(bid), to_double(ask)))


def money_product(units, price) -> Column:
    """units * price without losing scale: DECIMAL(13,0) * DECIMAL(24,9)."""
    return _either(safe_cast(units, WHOLE) * safe_cast(price, WORK), to_double(units) * to_double(price))


def case_label(c, when_true: str, when_false: str) -> Column:
    """Boolean to a label; NULL falls to the false label (CASE WHEN c THEN .. ELSE ..)."""
    return F.when(col_of(c), F.lit(when_true)).otherwise(F.lit(when_false))


def scale_pct(c) -> Column:
    """Ratio to percent on read."""
    return to_double(c) * F.lit(100)


def to_double(c) -> Column:
    return col_of(c).cast(T.DoubleType())


def display_money(c) -> Column:
    """NULL -> 'N/A', else '$x.xx'. format_string of NULL is not NULL, hence the CASE."""
    return F.when(col_of(c).isNull(), F.lit("N/A")).otherwise(
        F.format_string("$%.2f", to_double(c)))


def display_fixed(c, decimals: int = 2) -> Column:
    """NULL -> 'N/A', else the number with a fixed number of decimals."""
    return F.when(col_of(c).isNull(), F.lit("N/A")).otherwise(
        F.format_string(f"%.{int(decimals)}f", to_double(c)))


def display_count(c) -> Column:
    """NULL -> 'N/A', else the integer as text."""
    return F.when(col_of(c).isNull(), F.lit("N/A")).otherwise(col_of(c).cast("string"))


def kpi_number(c, decimals: int) -> Column:
    """KPI card value: NULL -> 0, thousands separators, fixed decimals."""
    return F.format_number(F.coalesce(to_double(c), F.lit(0.0)), int(decimals))


def as_date(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, (_dt.date, _dt.datetime)):
        return F.lit(d.isoformat()[:10]).cast("date")
    return F.lit(str(d)).cast("date")


def date_sub_days(as_of, days: int) -> Column:
    """DATE_SUB(as_of, INTERVAL days DAY); `as_of` defaults to current_date() when None."""
    base = F.current_date() if as_of is None else as_date(as_of)
    return F.date_sub(base, int(days))
