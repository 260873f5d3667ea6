"""Conditional expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(cond: Column) -> Column:
    """1 where true, 0 where false or null."""
    return F.when(cond, 1).otherwise(0)


# Hours of the parts of a day, months of the holiday season, limits and names of rate bands and states.


def day_part(hour: Column) -> Column:
    return (
        F.when(hour.between(5, 9), "morning")
        .when(hour.between(10, 15), "midday")
        .when(hour.between(16, 19), "evening")
        .otherwise("night")
    )


def is_weekend(weekday: Column) -> Column:
    """From a Monday-1 weekday."""
    return flag(weekday.isin(6, 7))


def is_holiday_season(month: Column) -> Column:
    return flag(month.isin(6, 7, 12))


def rate_band(rate: Column, low: float = 0.15, high: float = 0.25) -> Column:
    return F.when(rate < low, "low_delay").when(rate < high, "medium_delay").otherwise("high_delay")


def status_label(cancelled: Column, late: Column) -> Column:
    return F.when(cancelled == 1, "Cancelled").when(late == 1, "Delayed").otherwise("On-time")


def pick_by_flag(choice: Column, first: Column, second: Column) -> Column:
    """``first`` where the choice is 1, else ``second``."""
    return F.when(choice == 1, first).otherwise(second)


def mark_cancelled(outcome: Column, cancelled: Column, mark: int = 2) -> Column:
    """Missing outcome of a cancelled row as ``mark``."""
    return F.when(outcome.isNull() & (cancelled == 1), F.lit(mark)).otherwise(outcome)


def fold_mark(outcome: Column, mark: int = 2, into: int = 1) -> Column:
    """The mark counted as ``into``."""
    return F.when(outcome == mark, F.lit(into)).otherwise(outcome)


def negative_to_null(col: Column) -> Column:
    return F.when(col >= 0, col)
