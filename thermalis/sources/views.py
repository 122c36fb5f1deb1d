"""Temp views for callers who write SQL."""

from pyspark.sql import DataFrame

from thermalis.functions import decade_label, season_label


def register_views(obs: DataFrame) -> None:
    """uhi_data, and the same rows with a season (seasonal_data) or decade label (decade_data)."""
    obs.createOrReplaceTempView("uhi_data")
    obs.withColumn("season", season_label()).createOrReplaceTempView("seasonal_data")
    obs.withColumn("decade", decade_label()).createOrReplaceTempView("decade_data")
