"""Random-forest model, its evaluation, and the forecast inputs as joins."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermalis.functions import rnd, season_code
from thermalis.functions.fixed import BASE_YEAR, DRIFT_C, FORECAST_YEARS
from thermalis.operators.features import by_month

# Model inputs in order, and forest settings.
FEATURES = ["city_index", "year", "month", "season", "decade", "avg_urban_lst", "avg_rural_lst",
            "avg_night_lst", "prev_month_uhi", "prev_year_uhi", "rolling_3m_uhi"]
TREES, DEPTH, SEED, LABEL = 100, 5, 42, "avg_uhi"

#: Partitions of the training rows, and bins of a feature (the library's own default).
PARTITIONS, MAX_BINS = 8, 32


def city_indexer(keep_unknown: bool = False) -> StringIndexer:
    """City code by frequency, names ascending on ties. Unknown cities raise unless kept."""
    return StringIndexer(inputCol="city", outputCol="city_index",
                         handleInvalid="keep" if keep_unknown else "error")


def fixed_layout(df: DataFrame, partitions: int) -> DataFrame:
    """Same rows, same partitions: the forest samples by partition and position."""
    return df.repartition(partitions, "city").sortWithinPartitions("city", "year", "month")


def fit_forecaster(train: DataFrame, keep_unknown: bool = False, partitions: int = PARTITIONS,
                   max_bins: int = MAX_BINS) -> PipelineModel:
    """Index cities, assemble the features, fit the forest. Rows with a null feature are skipped.

    Training rows are one per city and month, so no partition of whole cities is hot; raise
    ``partitions`` with the number of cities. The city code is categorical and needs a bin per city, one more
    if unknown ones are kept: ``max_bins`` must reach that. Both change which forest is fitted.
    """
    train = fixed_layout(train, partitions)
    indexer = city_indexer(keep_unknown).fit(train)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="skip")
    codes = len(indexer.labels) + keep_unknown
    if codes > max_bins:
        raise ValueError(f"max_bins={max_bins} is too small: the city code needs {codes} bins")
    forest = RandomForestRegressor(featuresCol="features", labelCol=LABEL, numTrees=TREES,
                                   maxDepth=DEPTH, seed=SEED, maxBins=max_bins)
    return Pipeline(stages=[indexer, assembler, forest]).fit(train)


def test_predictions(scored: DataFrame) -> DataFrame:
    return scored.select("city", "year", "month", F.col(LABEL).alias("actual_uhi"),
                         rnd("prediction", 4).alias("predicted_uhi"))


def prediction_errors(scored: DataFrame) -> DataFrame:
    return scored.select("city", "year", "month", rnd(LABEL, 4).alias("actual"),
                         rnd("prediction", 4).alias("predicted"),
                         rnd(F.abs(F.col(LABEL) - F.col("prediction")), 4).alias("error"))


def evaluate(scored: DataFrame) -> DataFrame:
    """Mean absolute error, root mean squared error and R² in one aggregation, 4 decimals."""
    miss = F.col(LABEL) - F.col("prediction")
    sums = scored.filter(miss.isNotNull()).agg(
        F.avg(F.abs(miss)).alias("mae"), F.avg(miss * miss).alias("mse"), F.var_pop(LABEL).alias("spread"))
    return sums.select(rnd("mae", 4).alias("mae"), rnd(F.sqrt("mse"), 4).alias("rmse"),
                       rnd(1 - F.try_divide("mse", "spread"), 4).alias("r2"))


def importances(model: PipelineModel, session) -> DataFrame:
    """One row per feature, the most important first."""
    weights = model.stages[-1].featureImportances.toArray().tolist()
    table = session.createDataFrame(list(zip(FEATURES, weights)), "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def forecast_grid(cities: DataFrame, years=FORECAST_YEARS) -> DataFrame:
    """Every city with every month of the years, both ends included."""
    return (cities.select("city").distinct()
            .withColumn("year", F.explode(F.sequence(F.lit(years[0]), F.lit(years[1]))))
            .withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12)))))


def forecast_base(features: DataFrame, n: int = 24) -> DataFrame:
    """Mean temperatures of each city's last n monthly rows, nulls left out."""
    return (features.withColumn("back", F.row_number().over(by_month(descending=True)))
            .filter(F.col("back") <= n)
            .groupBy("city").agg(F.avg("avg_urban_lst").alias("base_urban"),
                                 F.avg("avg_rural_lst").alias("base_rural"),
                                 F.avg("avg_night_lst").alias("base_night")))


def forecast_month_base(features: DataFrame) -> DataFrame:
    """Mean of each calendar month's monthly values over all years."""
    return features.groupBy("city", "month").agg(F.avg("avg_uhi").alias("base_uhi"))


def forecast_inputs(features: DataFrame, trend: DataFrame, base_year: int = BASE_YEAR,
                    years=FORECAST_YEARS, drift=DRIFT_C) -> DataFrame:
    """Features of every future month: recent temperatures plus drift, monthly means plus trend.

    A city without trend has slope 0, a month without history base 0.
    """
    ahead = F.col("year") - F.lit(base_year)
    base = F.coalesce("base_uhi", F.lit(0.0))
    slope = F.coalesce("slope_per_year", F.lit(0.0))
    moved = rnd(base + slope * ahead, 4)
    return (forecast_grid(features, years)
            .join(forecast_base(features), "city", "left")
            .join(trend.select("city", "slope_per_year"), "city", "left")
            .join(forecast_month_base(features), ["city", "month"], "left")
            .select("city", "year", "month", season_code().alias("season"), F.lit(2).alias("decade"),
                    *[rnd(F.col(f"base_{side}") + ahead * F.lit(step), 2).alias(f"avg_{side}_lst")
                      for side, step in zip(("urban", "rural", "night"), drift)],
                    moved.alias("prev_month_uhi"),
                    rnd(base + slope * (ahead - 1), 4).alias("prev_year_uhi"),
                    moved.alias("rolling_3m_uhi"),
                    F.lit(0.0).alias("avg_uhi")))


def forecast(model: PipelineModel, inputs: DataFrame) -> DataFrame:
    return model.transform(inputs).select("city", "year", "month", rnd("prediction", 4).alias("predicted_uhi"))


def forecast_summary(predicted: DataFrame, years=FORECAST_YEARS) -> DataFrame:
    """Annual mean per city, one column per year."""
    span = list(range(years[0], years[1] + 1))
    wide = predicted.groupBy("city").pivot("year", span).agg(F.avg("predicted_uhi"))
    return wide.select("city", *[rnd(F.col(f"`{y}`"), 4).alias(str(y)) for y in span])
