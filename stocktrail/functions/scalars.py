"""Scalar and aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def day(ts) -> Column:
    """The calendar day of an instant; one group per day, 23:59:59.999 included."""
    return F.to_date(F.date_trunc("DAY", ts))


def two_digits(n) -> Column:
    """Zero-padded to two digits; 100 and above is an error."""
    n = F.col(n) if isinstance(n, str) else n
    text = n.cast("string")
    return F.when(n < 100, F.lpad(text, 2, "0")).when(
        n >= 100, F.raise_error(F.concat(F.lit("more than two digits: "), text)).cast("string")
    )


def iso_instant(ts) -> Column:
    """ISO-8601 text in UTC with milliseconds."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def thousands(c, decimals: int = 2) -> Column:
    return F.format_number(c, decimals)


def shift(ts, *, hours=0, minutes=0, seconds=0) -> Column:
    """An instant moved by a number of hours, minutes and seconds (numbers or columns)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    as_col = [v if isinstance(v, Column) else F.lit(v) for v in (hours, minutes, seconds)]
    return ts + F.make_dt_interval(F.lit(0), *as_col)


def dotted(*parts) -> Column:
    """``flow.step``, ``execute_sql.table`` and the like."""
    return F.concat_ws(".", *parts)


def cents(c) -> Column:
    """Money as whole cents: sums are then the same in any order."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * 100).cast("bigint")


def filled(c, default=0) -> Column:
    return F.coalesce(c, F.lit(default))


def sum_if(condition: Column, value) -> Column:
    """Sum of ``value`` where ``condition`` holds; NULL values and other rows count as 0."""
    return F.sum(F.when(condition, filled(value)).otherwise(F.lit(0)))


def out_of_stock(*available) -> Column:
    """1 when nothing is available from any source, a NULL source being empty."""
    total = sum((filled(F.col(a)) for a in available[1:]), filled(F.col(available[0])))
    return F.when(total <= 0, 1).otherwise(0)


def failed_fill(ordered, received) -> Column:
    """1 when less was received than ordered; nothing received yet counts as 0."""
    return F.when(filled(F.col(received)) < F.col(ordered), 1).otherwise(0)


def lead_time(placed, last_received, ordered, received) -> Column:
    """Days from placing to the last receipt, for lines that were received in full."""
    return F.when(
        F.col(received) >= F.col(ordered), F.datediff(F.col(last_received), F.col(placed))
    )


def ship_date(actual, requested) -> Column:
    return F.coalesce(F.col(actual), F.col(requested))
