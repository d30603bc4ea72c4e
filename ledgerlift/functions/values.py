"""Column expressions for amounts, dates and flags."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_sum(amount: Column) -> Column:
    """Sum of amounts or quantities that does not depend on the order of addition.

    Eight places hold every place of the source, so nothing is rounded before it is added.
    """
    return F.sum(amount.cast("decimal(28,8)")).cast("double")


def safe_ratio(amount: Column, divisor: Column) -> Column:
    """``amount / divisor`` to two places, 0 when the divisor is 0 or NULL.

    Divided as decimals: a double just below a half cent would round down.
    """
    top, bottom = amount.cast("decimal(24,8)"), divisor.cast("decimal(24,8)")
    return F.when(bottom != 0, F.round(top / bottom, 2).cast("double")).otherwise(F.lit(0.0))


def one_year_later(day: Column) -> Column:
    """Same day next year; 29 February becomes 28 February."""
    return F.add_months(F.to_date(day), 12)


def in_year(day: Column, year: int) -> Column:
    """Half-open date range, so that the filter reaches the scan."""
    return (day >= F.lit(f"{year}-01-01").cast("date")) & (
        day < F.lit(f"{year + 1}-01-01").cast("date")
    )


def before_year(day: Column, year: int) -> Column:
    return day < F.lit(f"{year}-01-01").cast("date")


def from_year(day: Column, year: int) -> Column:
    return day >= F.lit(f"{year}-01-01").cast("date")


def hidden_flag(active: Column) -> Column:
    """Active flag turned into a hidden flag; NULL counts as hidden."""
    return F.when(active == "S", "N").otherwise("S")


def control_kind(quantity: Column) -> Column:
    """``V`` (by value) for a quantity of one, else ``Q`` (by quantity)."""
    return F.when(quantity == 1, "V").otherwise("Q")
