"""Raw export rows to clean observations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermalis.schema import MEASURES, OBSERVATIONS


def _parsed_date(raw: DataFrame):
    """The date column, or the first of the month where the export has only year and month."""
    if "date" in raw.columns:
        if raw.schema["date"].dataType.typeName() != "string":
            return F.col("date").cast("date")
        return F.try_to_date("date", "yyyy-MM-dd")
    parts = F.format_string("%04d-%02d-01", F.col("year").try_cast("int"), F.col("month").try_cast("int"))
    return F.try_to_date(parts, "yyyy-MM-dd")


def with_calendar(df: DataFrame) -> DataFrame:
    """Year, month and day of year of the date column."""
    return df.withColumns({
        "year": F.year("date"), "month": F.month("date"), "day_of_year": F.dayofyear("date"),
    })


def clean(raw: DataFrame, sentinel: float | None = None) -> DataFrame:
    """Parse, cast and project raw rows; keep those with urban, rural and index values.

    Text that is no date or number becomes null. A sentinel such as -9999.0 is taken for a
    missing value, which drops rows that lack a side; by default it stays a value, as exported.
    """
    rows = raw.drop("system:index", ".geo").withColumn("date", _parsed_date(raw))
    rows = with_calendar(rows).withColumns({c: F.col(c).try_cast("double") for c in MEASURES})
    if sentinel is not None:
        rows = rows.withColumns({
            c: F.when(F.col(c) != F.lit(sentinel), F.col(c)) for c in MEASURES
        })
    return (rows.filter(F.col("LST_Day_Urban").isNotNull() & F.col("LST_Day_Rural").isNotNull()
                        & F.col("UHI_Index").isNotNull())
            .select(*OBSERVATIONS.names))
