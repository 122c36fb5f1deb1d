"""Pixel tables partitioned by tiles."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructField, StructType

from thermalis.operators.pixels import TILE_DEG, tile_columns
from thermalis.schema import PIXELS


def write_pixels(px: DataFrame, path: str, tile: float = TILE_DEG) -> None:
    """Parquet partitioned by tile, each file in the order of time, replacing what is there.

    The rebalance puts a tile in one file where it is small, and splits it over tasks where it is large.
    """
    (px.withColumns(tile_columns(tile)).hint("rebalance", "tile_x", "tile_y").sortWithinPartitions("tile_x", "tile_y", "t")
       .write.partitionBy("tile_x", "tile_y").mode("overwrite").parquet(path))


def read_pixels(spark: SparkSession, path: str) -> DataFrame:
    """The tiled table; tile_x and tile_y come last."""
    tiles = [StructField(name, IntegerType()) for name in ("tile_x", "tile_y")]
    return spark.read.schema(StructType([*PIXELS.fields, *tiles])).parquet(path)
