"""Year-over-year change, linear trend, moving average and peak month.

All of these work on a few rows per city, made by the grouped statistics.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermalis.functions import rnd, yoy_trend
from thermalis.operators.aggregates import month_climatology


def _by_year():
    return Window.partitionBy("city").orderBy(F.asc_nulls_first("year"))


def yoy(yearly_base: DataFrame) -> DataFrame:
    """Change against the previous row of the city; the first year counts as stable."""
    return (yearly_base
            .withColumn("prev_year_uhi", F.lag("avg_uhi", 1).over(_by_year()))
            .withColumn("yoy_change", rnd(F.col("avg_uhi") - F.col("prev_year_uhi"), 4))
            .withColumn("trend", yoy_trend(F.col("yoy_change"))))


def trend_rate(yearly_base: DataFrame, min_years: int = 5) -> DataFrame:
    """Least-squares slope per city over its yearly means.

    Cities with too few years drop out, as do rows without a city.
    """
    x, y = F.col("year").cast("double"), F.col("avg_uhi")
    fits = yearly_base.filter(F.col("city").isNotNull() & y.isNotNull()).groupBy("city").agg(
        F.count("*").alias("years"),
        F.regr_slope(y, x).alias("slope"),
        F.when(F.var_pop(y) == 0, F.lit(0.0)).otherwise(F.regr_r2(y, x)).alias("r2"),
        F.min_by("avg_uhi", "year").alias("first"),
        F.max_by("avg_uhi", "year").alias("last"),
    )
    return fits.filter(F.col("years") >= min_years).select(
        "city",
        rnd("slope", 6).alias("slope_per_year"),
        rnd(F.col("slope") * 10, 4).alias("rate_per_decade_c"),
        rnd("r2", 4).alias("r_squared"),
        rnd("first", 4).alias("first_year_uhi"),
        rnd("last", 4).alias("last_year_uhi"),
        rnd(F.col("last") - F.col("first"), 4).alias("overall_change"),
        F.when(F.col("slope") > 0, F.lit("Warming")).otherwise(F.lit("Cooling")).alias("trend"),
    )


def moving_avg(yearly_base: DataFrame, n: int = 5) -> DataFrame:
    """Mean of the last n yearly rows, fewer at the start."""
    frame = _by_year().rowsBetween(1 - n, 0)
    return yearly_base.select("city", "year", "avg_uhi",
                              rnd(F.avg("avg_uhi").over(frame), 4).alias(f"moving_avg_{n}yr"))


def peak_month(source: DataFrame) -> DataFrame:
    """Calendar month with the highest mean per city, the lower month on a tie."""
    order = Window.partitionBy("city").orderBy(F.desc_nulls_last("avg_uhi"), F.asc_nulls_first("month"))
    return (month_climatology(source)
            .withColumn("rn", F.row_number().over(order)).filter(F.col("rn") == 1).drop("rn")
            .withColumnsRenamed({"month": "peak_month", "avg_uhi": "peak_uhi"}))
