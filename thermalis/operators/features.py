"""Monthly model features."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermalis.functions import decade_code, rnd, season_code
from thermalis.functions.fixed import TRAIN_UNTIL
from thermalis.operators.aggregates import monthly_base

LAGS = ["prev_month_uhi", "prev_year_uhi", "rolling_3m_uhi"]


def by_month(descending: bool = False):
    """Window over a city's months."""
    order = F.desc_nulls_last if descending else F.asc_nulls_first
    return Window.partitionBy("city").orderBy(order("year"), order("month"))


def monthly_features(source: DataFrame, leak_free: bool = False) -> DataFrame:
    """Monthly means with codes, row-based lags and a three-row mean; missing lags count as 0.

    The three-row mean includes the month itself, that is the label. ``leak_free`` takes the three
    rows before it instead.
    """
    frame = by_month().rowsBetween(-3, -1) if leak_free else by_month().rowsBetween(-2, 0)
    return (monthly_base(source)
            .withColumns({"season": season_code(), "decade": decade_code()})
            .withColumns({
                "prev_month_uhi": F.lag("avg_uhi", 1).over(by_month()),
                "prev_year_uhi": F.lag("avg_uhi", 12).over(by_month()),
                "rolling_3m_uhi": rnd(F.avg("avg_uhi").over(frame), 4),
            })
            .fillna(0, subset=LAGS))


def time_split(features: DataFrame, last_train_year: int = TRAIN_UNTIL) -> tuple[DataFrame, DataFrame]:
    """Rows up to the year, and rows after it."""
    return (features.filter(F.col("year") <= last_train_year),
            features.filter(F.col("year") > last_train_year))
