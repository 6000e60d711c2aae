"""Column expressions. All are built-in Spark functions, so they stay inside
whole-stage code generation; none of them is a Python UDF."""

from vigil.functions.scalars import (
    batch_date_of,
    close_time,
    date_lit,
    feed_of,
    full_name,
    minutes_between,
    parse_amount,
    ts_lit,
    within_minutes,
)

__all__ = [
    "batch_date_of", "close_time", "date_lit", "feed_of", "full_name", "minutes_between",
    "parse_amount", "ts_lit", "within_minutes",
]
