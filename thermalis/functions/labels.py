"""Label and code expressions over calendar and measure columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from thermalis.functions.fixed import (
    CRITICAL_FACTOR, DECADE_YEARS, HIGH_FACTOR, MARKER_LEAST, MARKER_ORANGE, MARKER_RED, MARKER_SCALE, MONTH_NAMES,
    SEASON_MONTHS, SEASON_ORDER,
    YOY_BAND, YOY_DOWN, YOY_FLAT, YOY_UP,
)


def _cases(tests, values) -> Column:
    """First value whose test holds; the last value stands for everything else, null included."""
    chain = F
    for test, value in zip(tests, values[:-1]):
        chain = chain.when(test, F.lit(value))
    return chain.otherwise(F.lit(values[-1]))


def _season(month, values) -> Column:
    month = F.col(month) if isinstance(month, str) else month
    return _cases([month.isin(*SEASON_MONTHS[s]) for s in SEASON_ORDER], values)


def _decade(year, values) -> Column:
    year = F.col(year) if isinstance(year, str) else year
    return _cases([year.between(*span) for span in DECADE_YEARS.values()], values)


def season_label(month="month") -> Column:
    return _season(month, list(SEASON_ORDER))


def season_code(month="month") -> Column:
    return _season(month, list(range(len(SEASON_ORDER))))


def decade_label(year="year") -> Column:
    return _decade(year, list(DECADE_YEARS))


def decade_code(year="year") -> Column:
    return _decade(year, list(range(len(DECADE_YEARS))))


def season_order(season="season") -> Column:
    """Sort key 1..4 in calendar order of the seasons, 0 for an unknown label."""
    names = F.array(*[F.lit(s) for s in SEASON_ORDER])
    return F.array_position(names, F.col(season) if isinstance(season, str) else season)


def severity(uhi, p90) -> Column:
    """Alert band of a value already known to exceed p90."""
    return (F.when(uhi > p90 * CRITICAL_FACTOR, F.lit("CRITICAL"))
            .when(uhi > p90 * HIGH_FACTOR, F.lit("HIGH"))
            .otherwise(F.lit("MODERATE")))


def yoy_trend(change) -> Column:
    return (F.when(change > YOY_BAND, F.lit(YOY_UP))
            .when(change < -YOY_BAND, F.lit(YOY_DOWN))
            .otherwise(F.lit(YOY_FLAT)))


def month_name(month) -> Column:
    """Short month name, null when the number is not 1..12."""
    names = F.create_map(*[F.lit(x) for i, name in enumerate(MONTH_NAMES, 1) for x in (i, name)])
    return F.try_element_at(names, month)


def marker_color(uhi) -> Column:
    return F.when(uhi > MARKER_RED, F.lit("red")).when(uhi > MARKER_ORANGE, F.lit("orange")).otherwise(F.lit("blue"))


def marker_radius(uhi) -> Column:
    return F.greatest(F.abs(uhi) * MARKER_SCALE, F.lit(MARKER_LEAST))
