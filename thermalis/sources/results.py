"""Published result tables.

A publication writes its tables into a folder of its own and then a manifest, which says where each table is. Readers
go by the newest manifest: they see all of a publication or nothing, and a failed one leaves the tables before it readable.
"""

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermalis.schema import RESULTS, SERVED
from thermalis.sources.durable import remove

MANIFEST = "version string, name string, folder string"


def write_result(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a result as CSV with header or as Parquet, straight from the executors."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def _manifests(spark: SparkSession, base: str) -> DataFrame | None:
    try:
        return spark.read.schema(MANIFEST).parquet(f"{base}/_published/manifests/*")
    except AnalysisException as error:
        if not _missing(error):
            raise
        return None


def published(spark: SparkSession, base: str) -> dict[str, str]:
    """Folder of each table by the newest manifest; empty if nothing was published."""
    manifests = _manifests(spark, base)
    if manifests is None:
        return {}
    newest = manifests.agg(F.max("version")).scalar()
    # A manifest has a row per table, so some dozens.
    return {r.name: f"{base}/{r.folder}" for r in manifests.filter(F.col("version") == newest).collect()}


class Publication:
    """Tables that readers see together once ``commit`` is done. Tables published before stay as they are."""

    def __init__(self, spark: SparkSession, base: str, fmt: str = "csv"):
        self.spark, self.base, self.fmt = spark, base, fmt
        self.version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        self.folders: dict[str, str] = {}

    def write(self, name: str, table: DataFrame) -> DataFrame:
        """Write a table; the result reads what was written."""
        self.folders[name] = f"_published/versions/{self.version}/{name}"
        path = f"{self.base}/{self.folders[name]}"
        write_result(table, path, self.fmt)
        reader = self.spark.read.schema(table.schema)
        return (reader.option("header", True) if self.fmt == "csv" else reader).format(self.fmt).load(path)

    def commit(self) -> None:
        before = {name: path.removeprefix(f"{self.base}/") for name, path in published(self.spark, self.base).items()}
        rows = [(self.version, *entry) for entry in (before | self.folders).items()]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(f"{self.base}/_published/manifests/{self.version}")


def publish_tables(tables: dict[str, DataFrame], base: str, fmt: str = "csv") -> None:
    """Publish some tables together; others that were published before stay."""
    if tables:
        publication = Publication(next(iter(tables.values())).sparkSession, base, fmt)
        for name, table in tables.items():
            publication.write(name, table)
        publication.commit()


def remove_old_versions(spark: SparkSession, base: str) -> None:
    """Delete what the newest manifest does not name, once nobody reads it any more."""
    manifests = _manifests(spark, base)
    if manifests is None:
        return
    rows = manifests.collect()
    newest = max(r.version for r in rows)
    used = {r.folder for r in rows if r.version == newest}
    for folder in {r.folder for r in rows} - used:
        remove(spark, f"{base}/{folder}")
    for version in {r.version for r in rows} - {newest}:
        remove(spark, f"{base}/_published/manifests/{version}")


def read_result(spark: SparkSession, base: str, name: str, fmt: str = "csv", folders: dict[str, str] | None = None) -> DataFrame:
    """One published table, empty with the right columns if it was never written.

    A table that no manifest names is looked for as a folder of its name under base.
    """
    folders = published(spark, base) if folders is None else folders
    reader = spark.read.schema(RESULTS[name])
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    try:
        return reader.format(fmt).load(folders.get(name, f"{base}/{name}"))
    except AnalysisException as error:
        if not _missing(error):
            raise
        return spark.createDataFrame([], RESULTS[name])


def load_results(spark: SparkSession, base: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """The served tables by short name, all of one publication."""
    folders = published(spark, base)
    return {key: read_result(spark, base, name, fmt, folders) for key, name in SERVED.items()}


def read_trend(spark: SparkSession, base: str, fmt: str = "csv") -> DataFrame:
    """Trend table published earlier, as input of the forecast."""
    return read_result(spark, base, "uhi_rate_of_change", fmt)
