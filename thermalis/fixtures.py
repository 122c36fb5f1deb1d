"""Observations, pixels and regions derived from the generated star-schema tables.

The text is valid in Spark SQL and in DuckDB. Ship years 1995..2001 are stretched to 2000, 2004 ..
2024, so that all decades and both sides of the train split occur.
"""

from pyspark.sql import DataFrame, SparkSession

OBS_SQL = """
SELECT city, date, year, month, CAST(dayofyear(date) AS INT) AS day_of_year,
       urban AS LST_Day_Urban, urban - uhi AS LST_Day_Rural, night AS LST_Night_Urban, uhi AS UHI_Index
FROM (SELECT n_name AS city,
        make_date(CAST(2000+(year(l_shipdate)-1995)*4 AS INT), CAST(month(l_shipdate) AS INT),
                  CAST(day(l_shipdate) AS INT)) AS date,
        CAST(2000+(year(l_shipdate)-1995)*4 AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
        l_quantity AS urban,
        CASE WHEN l_returnflag='N' THEN NULL ELSE l_quantity-8 END AS night,
        (l_extendedprice/10000-4)*(1+10*l_discount)-(n_nationkey%12) AS uhi
      FROM {lineitem} JOIN {supplier} ON l_suppkey=s_suppkey JOIN {nation} ON s_nationkey=n_nationkey) t
"""

PIXELS_SQL = """
SELECT l_shipdate AS t,
       70+(l_suppkey%25%5)*3-CAST(0.2 AS DOUBLE)+(l_partkey%70)*CAST(0.01 AS DOUBLE) AS lon,
       10+CAST(floor((l_suppkey%25)/5) AS INT)*3-CAST(0.2 AS DOUBLE)+((l_partkey*7)%71)*CAST(0.01 AS DOUBLE) AS lat,
       CAST(l_linenumber%4 AS INT) AS QC_Day,
       13500+CAST(floor(l_extendedprice/50) AS INT) AS LST_Day_1km,
       13500+CAST(floor(l_quantity*20) AS INT) AS LST_Night_1km
FROM {lineitem}
"""

REGIONS_SQL = """
SELECT n_name AS city, CAST(70+(n_nationkey%5)*3 AS DOUBLE) AS x0,
       CAST(10+CAST(floor(n_nationkey/5) AS INT)*3 AS DOUBLE) AS y0,
       70+(n_nationkey%5)*3+CAST(0.3 AS DOUBLE) AS x1,
       10+CAST(floor(n_nationkey/5) AS INT)*3+CAST(0.3 AS DOUBLE) AS y1
FROM {nation}
"""

TABLES = ("lineitem", "supplier", "nation")
DUCK = {t: t for t in TABLES}


def _read(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{%s}" % t in text}
    return spark.sql(text, **frames)


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, OBS_SQL)


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, PIXELS_SQL)


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, REGIONS_SQL)


def coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions(spark, sf_dir).selectExpr("city", "(y0+y1)/2 AS lat", "(x0+x1)/2 AS lon")
