"""Filtered, pivoted and combined views for a dashboard."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from thermalis.functions import marker_color, marker_radius, month_name, rnd, season_order
from thermalis.functions.fixed import CITY_COORDS, MONTH_NAMES
from thermalis.operators.ordering import placed
from thermalis.schema import COORDS


def presented(df: DataFrame, *keys: str, desc: str | None = None, place: str | None = None) -> DataFrame:
    """Global sort: by a measure descending, then by the keys.

    With ``place`` that column has each row's place in the order, which a written table keeps.
    """
    order = [*([F.desc(desc)] if desc else []), *[F.asc(k) for k in keys]]
    return df.orderBy(*order) if place is None else placed(df, *order, place=place)


def head_n(df: DataFrame, n: int, *order) -> DataFrame:
    """The first n rows of an order that the caller makes total."""
    return df.orderBy(*order).limit(n)


def _year_number(df: DataFrame, year: str = "year"):
    """The year for comparison; a numeric column is left alone, so that the filter reaches the scan."""
    kind = df.schema[year].dataType
    return F.col(year) if isinstance(kind, NumericType) else F.col(year).try_cast("double")


def filter_result(df: DataFrame, cities=None, years: tuple[int, int] | None = None) -> DataFrame:
    """Rows of the cities and of the inclusive year range, each as far as the table has the column.

    No cities means all cities. A year that is no number is excluded.
    """
    if cities and "city" in df.columns:
        df = df.filter(F.col("city").isin(*cities))
    if years and "year" in df.columns:
        df = df.filter(_year_number(df).between(*years))
    return df


def filter_options(rankings: DataFrame, yearly: DataFrame) -> DataFrame:
    """Sorted distinct cities and years, one row each; the first five cities are preselected."""
    options = (rankings.select(F.lit("city").alias("option"), F.col("city").alias("value"))
               .unionByName(yearly.select(F.lit("year").alias("option"), F.col("year").cast("string").alias("value")))
               .filter(F.col("value").isNotNull()).distinct())
    rows = placed(options, "option", "value", place="all_places")
    first = rows.groupBy("option").agg(F.min("all_places").alias("first"))
    # One row for each of the two options.
    return (rows.join(F.broadcast(first), "option")
            .select("option", "value", (F.col("all_places") - F.col("first") + 1).cast("int").alias("place"))
            .withColumn("preselected", (F.col("option") == "city") & (F.col("place") <= 5)))


def year_range(yearly: DataFrame, default=(2000, 2024)) -> DataFrame:
    """First and last year, the default for an empty table."""
    return yearly.agg(F.coalesce(F.min("year"), F.lit(default[0])).alias("first_year"),
                      F.coalesce(F.max("year"), F.lit(default[1])).alias("last_year"))


def kpis(rankings: DataFrame) -> DataFrame:
    """Hottest and coolest city with their index, and mean city temperatures. The first name wins ties."""
    hot = F.min(F.struct((-F.col("avg_uhi")).alias("key"), "city", "avg_uhi"))
    cool = F.min(F.struct(F.col("avg_uhi").alias("key"), "city", "avg_uhi"))
    ranked = rankings.filter(F.col("avg_uhi").isNotNull())
    sums = ranked.agg(hot.alias("hot"), cool.alias("cool"), F.avg("avg_urban_temp").alias("urban"),
                      F.avg("avg_night_temp").alias("night"))
    return sums.select(F.col("hot.city").alias("hottest_city"), F.col("hot.avg_uhi").alias("hottest_uhi"),
                       F.col("cool.city").alias("coolest_city"), F.col("cool.avg_uhi").alias("coolest_uhi"),
                       rnd("urban", 1).alias("avg_urban_temp"), rnd("night", 1).alias("avg_night_temp"))


def map_points(rankings: DataFrame, coords: DataFrame | None = None) -> DataFrame:
    """Marker position, colour, radius and labels per city; a city without coordinates is left out."""
    if coords is None:
        coords = rankings.sparkSession.createDataFrame([(c, *p) for c, p in CITY_COORDS.items()], COORDS)

    def text(column, digits):
        return F.format_string(f"%.{digits}f°C", rnd(column, digits))

    uhi = F.col("avg_uhi")
    return rankings.join(coords, "city").select(
        "city", "lat", "lon", "avg_uhi", marker_color(uhi).alias("color"), marker_radius(uhi).alias("radius"),
        F.concat(F.col("city"), F.lit(": "), text("avg_uhi", 2)).alias("tooltip"),
        F.concat_ws("\n", F.col("city"), F.concat(F.lit("UHI: "), text("avg_uhi", 2)),
                    F.concat(F.lit("Urban: "), text("avg_urban_temp", 1)),
                    F.concat(F.lit("Peak: "), text("peak_uhi", 2))).alias("popup"))


def month_heatmap(monthly: DataFrame, cities=None, years=None) -> DataFrame:
    """Mean monthly index per city, one column per month name; a month without data is null."""
    rows = filter_result(monthly, cities, years)
    wide = rows.groupBy("city").pivot("month", list(range(1, 13))).agg(F.avg("avg_uhi"))
    return wide.select("city", *[F.col(f"`{i}`").alias(name) for i, name in enumerate(MONTH_NAMES, 1)])


def seasonal_ordered(seasonal: DataFrame, cities=None) -> DataFrame:
    """Seasonal rows with their place in the calendar, as the sort key of a chart."""
    return filter_result(seasonal, cities).withColumn("season_place", season_order())


def with_month_name(df: DataFrame, month: str = "month", to: str = "month_name") -> DataFrame:
    return df.withColumn(to, month_name(F.col(month)))


def peak_table(peaks: DataFrame, cities=None) -> DataFrame:
    return filter_result(peaks, cities).select(
        "city", month_name(F.col("peak_month")).alias("Peak Month"), F.col("peak_uhi").alias("Peak UHI (°C)"))


def forecast_yearly(predicted: DataFrame) -> DataFrame:
    """Mean prediction per city and year."""
    return (predicted.select("city", F.col("year").try_cast("int").alias("year"),
                             F.col("predicted_uhi").try_cast("double").alias("predicted_uhi"))
            .groupBy("city", "year").agg(F.avg("predicted_uhi").alias("uhi")))


def history_forecast(yearly: DataFrame, predicted: DataFrame, cities=None, years=None) -> DataFrame:
    """Yearly history within the year range followed by the whole forecast, rows without value dropped."""
    past = (filter_result(yearly, cities, years)
            .select("city", F.col("year").try_cast("int").alias("year"),
                    F.col("avg_uhi").alias("uhi"), F.lit("Historical").alias("type")))
    future = forecast_yearly(filter_result(predicted, cities)).withColumn("type", F.lit("Forecast"))
    return past.unionByName(future).dropna(subset=["year", "uhi"])


def alert_counts(alerts: DataFrame, cities=None, years=None) -> DataFrame:
    """Critical, high and all alerts; without a severity column the first two are 0."""
    def of(level):
        return F.count_if(F.col("severity") == level) if "severity" in alerts.columns else F.lit(0).cast("long")

    return filter_result(alerts, cities, years).agg(
        of("CRITICAL").alias("critical"), of("HIGH").alias("high"), F.count("*").alias("total"))


ALERT_ORDER = ["city", "date", "uhi_index", "urban_temp_c", "rural_temp_c"]
EXTREME_ORDER = ["city", "date", "UHI_Index", "LST_Day_Urban", "LST_Day_Rural", "LST_Night_Urban"]


def alerts_head(alerts: DataFrame, n: int, cities=None, years=None) -> DataFrame:
    return head_n(filter_result(alerts, cities, years), n, *[F.asc_nulls_first(c) for c in ALERT_ORDER])


def extreme_head(extreme: DataFrame, n: int, cities=None, years=None) -> DataFrame:
    return head_n(filter_result(extreme, cities, years), n, *[F.asc_nulls_first(c) for c in EXTREME_ORDER])
