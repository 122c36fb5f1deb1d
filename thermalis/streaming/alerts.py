"""Heat alerts on a stream of observations, with the batch expressions."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from thermalis.operators.hotspots import hotspots
from thermalis.schema import OBSERVATIONS


def stream_obs(spark: SparkSession, path: str) -> DataFrame:
    """New files of an observations table as a stream."""
    return spark.readStream.schema(OBSERVATIONS).parquet(path)


def hotspot_stream(obs: DataFrame, limits: DataFrame) -> DataFrame:
    """Alerts of streamed observations against fixed (settled) thresholds; no state is kept."""
    return hotspots(obs, limits)


def write_alerts(alerts: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append alerts as Parquet; ``once`` takes what is there and ends."""
    writer = alerts.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
