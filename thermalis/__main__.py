"""spark-submit jobs: ``python -m thermalis <job> ...`` with the session's own settings."""

import argparse

from pyspark.sql import SparkSession

from thermalis import plans, sources
from thermalis.functions.fixed import CITY_RECTANGLES
from thermalis.operators import forecast as fc
from thermalis.operators import pixels as pix
from thermalis.schema import REGIONS


def ingest(spark, a):
    sources.write_obs(plans.build_observations(spark, a.raw, a.sentinel), a.obs)
    sources.publish_tables({"uhi_all_clean": sources.clean_export(sources.read_obs(spark, a.obs))}, a.out, a.format)


def core(spark, a):
    sources.publish_tables(plans.core_analysis(sources.read_obs(spark, a.obs)), a.out, a.format)


def hotspots(spark, a):
    sources.publish_tables(plans.hotspot_tables(sources.read_obs(spark, a.obs)), a.out, a.format)
    sources.publish_tables(plans.alert_reports(sources.read_result(spark, a.out, "hotspot_alerts", a.format)), a.out, a.format)


def temporal(spark, a):
    sources.publish_tables(plans.temporal_analysis(sources.read_obs(spark, a.obs)), a.out, a.format)


def forecast(spark, a):
    """Uses the trend that the temporal job published."""
    trend = sources.read_trend(spark, a.out, a.format)
    done = plans.forecast_pipeline(sources.read_obs(spark, a.obs), trend, partitions=a.partitions, max_bins=a.max_bins)
    sources.publish_tables(done.results, a.out, a.format)
    sources.save_model(done.model, a.model)


def regions_of(spark, a):
    """The rectangles of the CSV file --regions, else the built-in ones."""
    if a.regions:
        return spark.read.schema(REGIONS).option("header", True).csv(a.regions)
    return spark.createDataFrame([(c, *map(float, r)) for c, r in CITY_RECTANGLES.items()], REGIONS)


def tile(spark, a):
    """Pixel table to one that is partitioned by tile."""
    sources.write_pixels(spark.read.parquet(a.raw), a.out)


def pixels(spark, a):
    """Pixel table, tiled or not, to one CSV folder per city."""
    series = plans.pixels_to_observations(spark.read.parquet(a.raw), regions_of(spark, a), (a.first_year, a.last_year),
                                          footprint=a.footprint and (a.footprint, a.footprint))
    sources.write_by_city(series, a.out)


def cleanup(spark, a):
    """Delete published tables that newer ones have replaced."""
    sources.remove_old_versions(spark, a.out)


def period_mean(spark, a):
    """Mean day temperature per pixel over the years."""
    px = pix.select_period(spark.read.parquet(a.raw), f"{a.first_year}-01-01", f"{a.last_year + 1}-01-01", ["LST_Day_1km"])
    sources.publish_tables({"pixel_period_mean": pix.period_mean(pix.to_celsius(px))}, a.out, a.format)


def per_image(spark, a):
    """Urban and rural mean of every city and image of the years."""
    px = pix.select_period(spark.read.parquet(a.raw), f"{a.first_year}-01-01", f"{a.last_year + 1}-01-01")
    series = pix.zonal_per_image(pix.to_celsius(pix.qa_mask(px)), regions_of(spark, a))
    sources.publish_tables({"zonal_per_image": series}, a.out, a.format)


def publish(spark, a):
    model = plans.publish(spark, a.raw, a.obs, a.out, a.format, a.sentinel, a.partitions, a.max_bins)
    sources.save_model(model, a.model)


JOBS = {job.__name__: job for job in (ingest, core, hotspots, temporal, forecast, tile, pixels, period_mean, per_image, publish, cleanup)}


def main(argv=None):
    parser = argparse.ArgumentParser(prog="thermalis")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--raw", default="data/raw/*.csv", help="CSV exports; the pixel table for tile, pixels, period_mean, per_image")
    parser.add_argument("--regions", help="CSV of city, x0, y0, x1, y1 for pixels and per_image")
    parser.add_argument("--obs", default="data/parquet", help="observations table")
    parser.add_argument("--out", default="data/output", help="published tables")
    parser.add_argument("--model", default="data/models/forecaster")
    parser.add_argument("--format", choices=["csv", "parquet"], default="csv")
    parser.add_argument("--sentinel", type=float, help="value that marks missing data, such as -9999")
    parser.add_argument("--partitions", type=int, default=fc.PARTITIONS, help="partitions of the training rows")
    parser.add_argument("--max-bins", type=int, default=fc.MAX_BINS, help="bins of a feature, at least one per city")
    parser.add_argument("--footprint", type=float, help="side of a pixel in degrees: edge pixels count by their share (pixels)")
    parser.add_argument("--first-year", type=int, default=2000)
    parser.add_argument("--last-year", type=int, default=2024)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"thermalis-{args.job}").getOrCreate()
    with sources.scratch_run(spark):
        JOBS[args.job](spark, args)


if __name__ == "__main__":
    main()
