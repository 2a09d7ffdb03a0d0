"""Sums and means of amounts, exact to the cent whatever the order of the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Six decimals and fourteen digits before them; an amount beyond, a NaN or an infinity counts as NULL.
AMOUNT = "decimal(20,6)"


def _exact(amount: Column | str) -> Column:
    return (F.col(amount) if isinstance(amount, str) else amount).try_cast(AMOUNT)


def exact_sum(amount: Column | str) -> Column:
    """The sum in decimals, as a double."""
    return F.sum(_exact(amount)).cast("double")


def exact_avg(amount: Column | str) -> Column:
    """The mean from the decimal sum; NULL if there is no amount."""
    return F.try_divide(exact_sum(amount), F.count(_exact(amount)))
