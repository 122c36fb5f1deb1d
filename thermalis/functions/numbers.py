"""Number helpers: the one rounding rule and a division that yields null instead of an error."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def rnd(value, digits: int) -> Column:
    """Round half-up on the decimal value, back to double.

    Noise beyond the tenth decimal (for instance from another summation order) is cut first, so
    that the result does not depend on how the rows were split. NaN, infinities and values too
    large for the decimal pass unchanged.
    """
    value = F.col(value) if isinstance(value, str) else value
    exact = F.round(value.try_cast("decimal(38,10)"), digits).cast("double")
    return F.coalesce(exact, value)


def rnd_rows(value, digits: int) -> Column:
    """The same result as ``rnd``, for columns of whole tables.

    Away from a tie, and for values small enough that the product keeps its decimals, plain
    arithmetic finds the nearest step; only the rest takes the slower decimal.
    """
    value = F.col(value) if isinstance(value, str) else value
    steps = F.lit(10.0 ** digits)
    scaled = value * steps
    no_tie = F.abs(scaled - F.floor(scaled) - 0.5) > 1e-5
    return F.when((F.abs(value) < 1e5) & no_tie, F.floor(scaled + 0.5) / steps).otherwise(rnd(value, digits))


def mean_of(total, n) -> Column:
    """total / n, null where n is 0."""
    return F.try_divide(total, n)
