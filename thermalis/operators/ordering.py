"""Places in a global order, found by many tasks."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermalis.sources.durable import settle

ROW_ID = "__row_id"
#: monotonically_increasing_id has the row's number within its partition in the lower bits.
ROW_BITS = 33


def placed(df: DataFrame, *order: str | Column, place: str = "place") -> DataFrame:
    """Adds the place of every row in the order, from 1 without gaps.

    Each task sorts one range of the order and numbers its rows; the ranges' sizes give the offsets. So no task
    numbers all rows, and only one number per range goes to one place. Rows that the order does not tell apart have
    any of their places.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Ranges are cut after a look at the rows, so all that follows reads the numbered table.
    rows = settle(df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
                  .withColumn(ROW_ID, F.monotonically_increasing_id()), "ordered")
    part = F.shiftright(ROW_ID, ROW_BITS)
    sizes = rows.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("part").alias("__part"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("__before"))
    within = F.col(ROW_ID).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    # As many offsets as ranges.
    return (rows.join(F.broadcast(offsets), part == F.col("__part"))
            .select(*df.columns, (F.col("__before") + within + 1).alias(place)))
