"""Reading and writing of observations."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from thermalis.schema import OBSERVATIONS

def read_raw(spark: SparkSession, path, schema: StructType | str | None = None) -> DataFrame:
    """All CSV files under a path, glob or list of paths.

    Without a schema every column is text named by the header, and no pass over the data infers
    types. Each file's header must match, so a file with other columns raises.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_obs(spark: SparkSession, path: str) -> DataFrame:
    """The partitioned Parquet table; city and year come last. City names are never read as numbers."""
    return spark.read.schema(OBSERVATIONS).parquet(path)


def write_obs(obs: DataFrame, path: str) -> None:
    """Parquet partitioned by city and year, replacing what is there.

    The rebalance puts a city-year in one file where it is small, and splits it over tasks where
    it is larger than the advisory partition size.
    """
    (obs.hint("rebalance", "city", "year")
        .write.partitionBy("city", "year").mode("overwrite").parquet(path))


def write_by_city(df: DataFrame, path: str) -> None:
    """CSV with one folder per city."""
    (df.hint("rebalance", "city")
       .write.partitionBy("city").mode("overwrite").option("header", True).csv(path))


def clean_export(obs: DataFrame) -> DataFrame:
    """Every clean row, in the published column order; the executors write them."""
    return obs.select(*OBSERVATIONS.names)
