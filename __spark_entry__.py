"""Registered queries over the generated tables, and the SQL that checks them.

``oracle_sql`` lives in ``oracle_queries.py``. The model queries have no SQL; the operators behind
them (evaluation, errors, summaries, forecast tables) are also checked with a SQL-expressible
stand-in for the model's output.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle_queries import CITIES, PIXEL_YEARS, YEARS  # noqa: E402
from oracle_queries import oracle_sql as library_sql  # noqa: E402
from thermalis import fixtures as fx  # noqa: E402
from thermalis import plans, sources, streaming  # noqa: E402
from thermalis.functions import rnd  # noqa: E402
from thermalis.operators import aggregates as agg  # noqa: E402
from thermalis.operators import features as feat  # noqa: E402
from thermalis.operators import forecast as fc  # noqa: E402
from thermalis.operators import forest  # noqa: E402
from thermalis.operators import hotspots as hot  # noqa: E402
from thermalis.operators import ingest  # noqa: E402
from thermalis.operators import pixels as pix  # noqa: E402
from thermalis.operators import serving as srv  # noqa: E402
from thermalis.operators import temporal as tmp  # noqa: E402

try:
    import corpus_pipeline
    from thermalis.llm import registry as corpus_queries
except ModuleNotFoundError as missing:  # the folders, or what only they need, may not be there; then their queries are not
    if (missing.name or "").startswith("thermalis") and missing.name != "thermalis.llm":
        raise
    corpus_pipeline = corpus_queries = None

__all__ = ["entry", "oracle_sql", "queries"]

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"
#: A stream over a written table that takes longer has failed.
STREAM_SECONDS = 3600


def stable(df: DataFrame, *columns: str) -> DataFrame:
    """Unrounded means to 6 decimals, so that they compare across summation orders."""
    return df.withColumns({c: rnd(F.col(c), 6) for c in columns})


# -- inputs ------------------------------------------------------------------------------------

def _on_obs(operator) -> Query:
    return lambda spark, sf: operator(fx.obs(spark, sf))


def _yearly_base(spark, sf):
    return agg.yearly_base(fx.obs(spark, sf))


def _features(spark, sf):
    return feat.monthly_features(fx.obs(spark, sf))


def _alerts(spark, sf):
    return hot.hotspots(fx.obs(spark, sf))


def _inputs(spark, sf):
    source = plans.settled_cells(fx.obs(spark, sf))
    return fc.forecast_inputs(feat.monthly_features(source), tmp.trend_rate(agg.yearly_base(source)))


def _projected(spark, sf):
    """Forecast table with the trend projection in place of a prediction."""
    return _inputs(spark, sf).select("city", "year", "month", F.col("prev_month_uhi").alias("predicted_uhi"))


def _naive(spark, sf):
    """Test rows scored with the previous month's value."""
    return feat.time_split(_features(spark, sf))[1].withColumn("prediction", F.col("prev_month_uhi"))


def _celsius(spark, sf):
    return pix.to_celsius(pix.qa_mask(fx.pixels(spark, sf)))


def _regions(spark, sf):
    """Grid cells of the regions as a table of known size."""
    return sources.settle(pix.region_cells(fx.regions(spark, sf)), "region-cells")


def _zone_composite(spark, sf):
    return pix.zone_composite(_celsius(spark, sf), _regions(spark, sf), PIXEL_YEARS)


def _composite(spark, sf):
    return pix.monthly_composite(_celsius(spark, sf), PIXEL_YEARS)


def _east(lon):
    """Places moved so that a column of cities lies across the date line."""
    moved = F.col(lon) + F.lit(103.85)
    return F.when(moved > 180, moved - 360).otherwise(moved)


# -- sources and sinks ---------------------------------------------------------------------------

def _raw_csv(df: DataFrame, label: str) -> str:
    """Write rows as a CSV export with bookkeeping columns."""
    path = sources.scratch_path(df.sparkSession, label)
    raw = df.withColumns({"system:index": F.lit("0_0"), ".geo": F.lit('{"type":"MultiPoint","coordinates":[]}')})
    sources.write_result(raw, path)
    return path


def ingest_clean(spark, sf):
    """CSV export in which the rural value of leap days is no number."""
    obs = fx.obs(spark, sf).drop("year", "month", "day_of_year")
    leap_day = (F.month("date") == 2) & (F.dayofmonth("date") == 29)
    raw = obs.withColumn("LST_Day_Rural", F.when(leap_day, F.lit("n/a"))
                         .otherwise(F.col("LST_Day_Rural").cast("string")))
    return plans.build_observations(spark, _raw_csv(raw, "raw"))


def ingest_year_month(spark, sf):
    """CSV export with year and month but no date."""
    rows = agg.monthly(fx.obs(spark, sf)).select(
        "city", "year", "month", F.col("avg_urban_lst").alias("LST_Day_Urban"),
        F.col("avg_rural_lst").alias("LST_Day_Rural"), F.col("avg_night_lst").alias("LST_Night_Urban"),
        F.col("avg_uhi").alias("UHI_Index"))
    return plans.build_observations(spark, _raw_csv(rows, "raw-monthly"))


def ingest_sentinel(spark, sf):
    """CSV export with -9999 for missing night values and for every rural value of January."""
    obs = fx.obs(spark, sf)
    raw = obs.withColumns({
        "LST_Night_Urban": F.coalesce("LST_Night_Urban", F.lit(-9999.0)),
        "LST_Day_Rural": F.when(F.col("month") == 1, F.lit(-9999.0)).otherwise(F.col("LST_Day_Rural")),
    })
    return plans.build_observations(spark, _raw_csv(raw, "raw-sentinel"), sentinel=-9999.0)


def obs_roundtrip(spark, sf):
    path = sources.scratch_path(spark, "obs")
    sources.write_obs(fx.obs(spark, sf), path)
    return sources.read_obs(spark, path)


def by_city_roundtrip(spark, sf):
    yearly = agg.yearly(fx.obs(spark, sf))
    path = sources.scratch_path(spark, "by-city")
    sources.write_by_city(yearly, path)
    return spark.read.schema(yearly.schema).option("header", True).csv(path)


def results_roundtrip(spark, sf):
    """Row counts of the loaded tables after publishing only the core reports."""
    base = sources.scratch_path(spark, "results")
    for name, table in plans.core_analysis(fx.obs(spark, sf)).items():
        sources.write_result(table, f"{base}/{name}")
    counts = [table.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
              for name, table in sources.load_results(spark, base).items()]
    union = counts[0]
    for one in counts[1:]:
        union = union.unionByName(one)
    return union


def sql_views(spark, sf):
    """SQL text over the registered views."""
    sources.register_views(fx.obs(spark, sf))
    rows = spark.sql("""
        SELECT 'season' AS kind, season AS label, count(*) AS n, avg(UHI_Index) AS avg_uhi FROM seasonal_data GROUP BY season
        UNION ALL
        SELECT 'decade', decade, count(*), avg(UHI_Index) FROM decade_data GROUP BY decade
        UNION ALL
        SELECT 'all', 'all', count(*), avg(UHI_Index) FROM uhi_data""")
    return rows.withColumn("avg_uhi", rnd("avg_uhi", 4))


def row_counts(spark, sf):
    counts = agg.city_counts(fx.obs(spark, sf))
    return counts.agg(F.sum("count").alias("records"), F.count("city").alias("cities"))


# -- alerts --------------------------------------------------------------------------------------

def hotspot_stream(spark, sf):
    """The alerts again, from a stream over the written observations, run to the end."""
    path, out, state = (sources.scratch_path(spark, x) for x in ("stream-obs", "stream-alerts", "stream-state"))
    sources.write_obs(fx.obs(spark, sf), path)
    limits = plans.settled_thresholds(sources.read_obs(spark, path))
    alerts = streaming.hotspot_stream(streaming.stream_obs(spark, path), limits)
    if not streaming.write_alerts(alerts, out, state, once=True).awaitTermination(STREAM_SECONDS):
        raise TimeoutError("the stream has not taken in all observations")
    return spark.read.schema(alerts.schema).parquet(out)


# -- model ---------------------------------------------------------------------------------------

_fitted: dict[tuple[str, str], plans.Forecast] = {}


def _forecast(spark, sf) -> plans.Forecast:
    """The fitted pipeline, once per session and input."""
    key = spark.sparkContext.applicationId, sf
    if key not in _fitted:
        _fitted[key] = plans.forecast_pipeline(fx.obs(spark, sf))
    return _fitted[key]


def _from_model(name: str) -> Query:
    return lambda spark, sf: _forecast(spark, sf).results[name]


def ml_scored_rows(spark, sf):
    """The rows that the model scored, without its predictions."""
    return _forecast(spark, sf).results["test_predictions"].drop("predicted_uhi")


def ml_forecast_rows(spark, sf):
    return _forecast(spark, sf).results["uhi_forecast_2025_2030"].drop("predicted_uhi")


def split_counts(spark, sf):
    train, test = feat.time_split(_features(spark, sf))
    sides = train.select(F.lit("train").alias("side")).unionByName(test.select(F.lit("test").alias("side")))
    return sides.agg(F.count_if(F.col("side") == "train").alias("train_rows"),
                     F.count_if(F.col("side") == "test").alias("test_rows"))


def city_index(spark, sf):
    train = sources.settle(feat.time_split(_features(spark, sf))[0], "train")
    return fc.city_indexer().fit(train).transform(train.select("city").distinct())


# -- pixels --------------------------------------------------------------------------------------

def pixel_period_mean(spark, sf):
    px = pix.select_period(fx.pixels(spark, sf), "1998-01-01", "1999-01-01", ["LST_Day_1km"])
    return stable(pix.period_mean(pix.to_celsius(px)), "mean_day_c")


def pixel_monthly(spark, sf):
    composite = sources.settle(_composite(spark, sf), "composite")
    return stable(pix.filled_composite(composite, PIXEL_YEARS), "LST_Day_C", "LST_Night_C")


def _zonal_mean(zone):
    return lambda spark, sf: stable(pix.zonal_mean(_composite(spark, sf), _regions(spark, sf), zone), "LST_Day_C", "LST_Night_C")


SERIES = ["LST_Day_Urban", "LST_Day_Rural", "LST_Night_Urban", "UHI_Index"]


def zonal_series_filled(spark, sf):
    return stable(plans.pixels_to_observations(fx.pixels(spark, sf), fx.regions(spark, sf), PIXEL_YEARS), *SERIES)


def zonal_series_tiled(spark, sf):
    """The series again, from a table of pixels that is partitioned by tile."""
    path = sources.scratch_path(spark, "pixels")
    sources.write_pixels(fx.pixels(spark, sf), path)
    masked = pix.to_celsius(pix.qa_mask(sources.read_pixels(spark, path)))
    composite = pix.zone_composite(masked, _regions(spark, sf), PIXEL_YEARS)
    return stable(pix.zonal_series(composite, PIXEL_YEARS), *SERIES)


def zonal_series_weighted(spark, sf):
    """The filled series where pixels on an edge count by their share."""
    found = plans.pixels_to_observations(fx.pixels(spark, sf), fx.regions(spark, sf), PIXEL_YEARS, footprint=(0.01, 0.01))
    return stable(found, *SERIES)


def zones_date_line(spark, sf):
    """Pixels of each zone when some cities lie across the date line."""
    px = _celsius(spark, sf).withColumn("lon", _east("lon"))
    regions = fx.regions(spark, sf).withColumns({"x0": _east("x0"), "x1": _east("x1")})
    rows = pix.zones(px, sources.settle(pix.region_cells(regions), "region-cells"))
    return stable(rows.groupBy("city", "zone").agg(F.count("*").alias("n"), F.avg("LST_Day_C").alias("mean_day_c")), "mean_day_c")


# -- whole analyses, and checks of what no SQL can compute ------------------------------------------

def _counts(spark, tables):
    """name, n: the number of rows of each table."""
    union = None
    for name, table in tables.items():
        one = table.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        union = one if union is None else union.unionByName(one)
    return union


def serving_report(spark, sf):
    """Row counts of all views behind a dashboard, from tables that were published before."""
    base = sources.scratch_path(spark, "results")
    obs = fx.obs(spark, sf)
    cells = plans.settled_cells(obs)
    tables = {**plans.core_analysis(cells), **plans.temporal_analysis(cells), **plans.hotspot_tables(obs, cells),
              "uhi_all_clean": sources.clean_export(obs), "uhi_forecast_2025_2030": _projected(spark, sf)}
    sources.publish_tables(tables, base, "parquet")
    results = sources.load_results(spark, base, "parquet")
    return _counts(spark, plans.serving_views(results, CITIES, YEARS, fx.coords(spark, sf)))


def republished(spark, sf):
    """Row counts of a report that was published twice, the second time over fewer cities, beside one of the first time."""
    base = sources.scratch_path(spark, "results")
    obs = fx.obs(spark, sf)
    sources.publish_tables({"uhi_yearly": agg.yearly(obs), "uhi_decade": agg.decade(obs)}, base)
    sources.publish_tables({"uhi_yearly": srv.filter_result(agg.yearly(obs), CITIES)}, base)
    sources.remove_old_versions(spark, base)
    return _counts(spark, {name: sources.read_result(spark, base, name) for name in ("uhi_yearly", "uhi_decade", "uhi_monthly")})


def trend_readback(spark, sf):
    """The trend as the forecast job reads it."""
    base = sources.scratch_path(spark, "results")
    sources.publish_tables({"uhi_rate_of_change": tmp.trend_rate(_yearly_base(spark, sf))}, base)
    return sources.read_trend(spark, base)


def _off(rows, a, b, limit=1e-9):
    """Number of rows, and of those where two columns differ or one is missing."""
    off = F.coalesce(F.abs(F.col(a) - F.col(b)) > limit, F.lit(True))
    return rows.agg(F.count("*").alias("n"), F.count_if(off).alias("n_off"))


def forest_walk(spark, sf):
    """Test rows for which walking the forest's table of nodes does not give the model's prediction."""
    done = _forecast(spark, sf)
    walked = forest.walk(done.scored, forest.node_table(done.model, spark), "city", "year", "month")
    return _off(done.scored.join(walked, ["city", "year", "month"], "left"), "prediction", "walked")


def forest_walk_forecast(spark, sf):
    """The same for the months of the forecast, and for its published values."""
    done = _forecast(spark, sf)
    scored = sources.settle(done.model.transform(_inputs(spark, sf)).select("city", "year", "month", "city_index", *fc.FEATURES[3:], "prediction"), "scored")
    walked = forest.walk(scored, forest.node_table(done.model, spark), "city", "year", "month").withColumn("walked", rnd("walked", 4))
    return _off(done.results["uhi_forecast_2025_2030"].join(walked, ["city", "year", "month"], "left"), "predicted_uhi", "walked", 1e-4)


def forest_importances(spark, sf):
    """Features whose importance the nodes do not give again."""
    done = _forecast(spark, sf)
    again = forest.node_importances(forest.node_table(done.model, spark)).withColumnRenamed("importance", "again")
    both = done.results["feature_importance"].join(again, "feature", "left").fillna(0.0, ["again"])
    return _off(both, "importance", "again")


def model_metrics(spark, sf):
    """Metrics that MLlib's own evaluator does not give again."""
    done = _forecast(spark, sf)
    scored = sources.settle(done.scored.select("avg_uhi", "prediction"), "scored")
    own = done.results["metrics"].select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("mae", "rmse", "r2")])))
    again = spark.createDataFrame([(m, RegressionEvaluator(labelCol="avg_uhi", metricName=m).evaluate(scored)) for m in ("mae", "rmse", "r2")],
                                  "metric string, again double")
    return _off(own.join(again, "metric", "left"), "value", "again", 5.1e-5)


def model_roundtrip(spark, sf):
    """Test rows that the saved and loaded model scores otherwise."""
    done = _forecast(spark, sf)
    path = sources.scratch_path(spark, "model")
    sources.save_model(done.model, path)
    rows = done.scored.select("city", *fc.FEATURES[1:], F.col("prediction").alias("before"))
    return _off(sources.load_model(path).transform(rows), "before", "prediction", 0.0)


def threshold_ranks(spark, sf):
    """City and level: whether the sketched percentile has the wanted rank, give or take half a percent of the city's values."""
    obs = fx.obs(spark, sf)
    limits = sources.settle(hot.sketched_thresholds(sources.settle(hot.measure_sketches(obs), "sketches"), rounded=False), "limits")
    return hot.threshold_ranks(obs, limits).select("city", "level", "n", "wanted", (F.col("error") <= 0.005).alias("near"))


def library_queries() -> dict[str, Query]:
    return {
        "ingest_clean": ingest_clean,
        "ingest_year_month": ingest_year_month,
        "ingest_sentinel": ingest_sentinel,
        "obs_roundtrip": obs_roundtrip,
        "by_city_roundtrip": by_city_roundtrip,
        "results_roundtrip": results_roundtrip,
        "clean_export": _on_obs(sources.clean_export),
        "row_counts": row_counts,
        "sql_views": sql_views,
        "city_counts": _on_obs(agg.city_counts),
        "monthly": _on_obs(agg.monthly),
        "yearly": _on_obs(agg.yearly),
        "seasonal": _on_obs(agg.seasonal),
        "decade": _on_obs(agg.decade),
        "rankings": _on_obs(agg.rankings),
        "yearly_base": _yearly_base,
        "seasonal_decade": _on_obs(agg.seasonal_decade),
        "month_climatology": _on_obs(agg.month_climatology),
        "thresholds": _on_obs(hot.thresholds),
        "threshold_ranks": threshold_ranks,
        "thresholds_approx": _on_obs(lambda obs: hot.thresholds(obs, exact=False)),
        "hotspots": _alerts,
        "hotspot_summary": lambda spark, sf: hot.hotspot_summary(_alerts(spark, sf)),
        "hotspot_monthly": lambda spark, sf: hot.hotspot_monthly(_alerts(spark, sf)),
        "hotspot_stream": hotspot_stream,
        "extreme_heat": _on_obs(hot.extreme_heat),
        "top_events": _on_obs(hot.top_events),
        "yoy": lambda spark, sf: tmp.yoy(_yearly_base(spark, sf)),
        "trend_rate": lambda spark, sf: tmp.trend_rate(_yearly_base(spark, sf)),
        "moving_avg": lambda spark, sf: tmp.moving_avg(_yearly_base(spark, sf)),
        "peak_month": _on_obs(tmp.peak_month),
        "features": _features,
        "features_leak_free": _on_obs(lambda obs: feat.monthly_features(obs, leak_free=True)),
        "split_counts": split_counts,
        "city_index": city_index,
        "forecast_grid": lambda spark, sf: fc.forecast_grid(_features(spark, sf)),
        "forecast_base": lambda spark, sf: stable(fc.forecast_base(_features(spark, sf)),
                                                  "base_urban", "base_rural", "base_night"),
        "forecast_month_base": lambda spark, sf: stable(fc.forecast_month_base(_features(spark, sf)), "base_uhi"),
        "forecast_inputs": _inputs,
        "forecast_summary": lambda spark, sf: fc.forecast_summary(_projected(spark, sf)),
        "forecast_yearly": lambda spark, sf: stable(srv.forecast_yearly(_projected(spark, sf)), "uhi"),
        "evaluate": lambda spark, sf: fc.evaluate(_naive(spark, sf)),
        "prediction_errors": lambda spark, sf: fc.prediction_errors(_naive(spark, sf)),
        "ml_test_predictions": _from_model("test_predictions"),
        "ml_scored_rows": ml_scored_rows,
        "ml_forecast_rows": ml_forecast_rows,
        "ml_metrics": _from_model("metrics"),
        "ml_prediction_errors": _from_model("prediction_errors"),
        "ml_feature_importance": _from_model("feature_importance"),
        "ml_forecast": _from_model("uhi_forecast_2025_2030"),
        "ml_forecast_summary": _from_model("forecast_summary"),
        "forest_walk": forest_walk,
        "forest_walk_forecast": forest_walk_forecast,
        "forest_importances": forest_importances,
        "model_metrics": model_metrics,
        "model_roundtrip": model_roundtrip,
        "trend_readback": trend_readback,
        "republished": republished,
        "hotspot_report": _on_obs(lambda obs: _counts(obs.sparkSession, plans.hotspot_analysis(obs))),
        "temporal_report": _on_obs(lambda obs: _counts(obs.sparkSession, plans.temporal_analysis(obs))),
        "serving_report": serving_report,
        "ordered_by_key": lambda spark, sf: srv.presented(agg.monthly(fx.obs(spark, sf)), "city", "year", "month", place="place"),
        "ordered_by_measure": lambda spark, sf: srv.presented(
            tmp.trend_rate(_yearly_base(spark, sf)), "city", desc="rate_per_decade_c", place="place"),
        "ordered_history": lambda spark, sf: stable(srv.presented(
            srv.history_forecast(agg.yearly(fx.obs(spark, sf)), _projected(spark, sf), years=YEARS), "city", "year", place="place"), "uhi"),
        "ordered_observations": _on_obs(lambda obs: srv.presented(obs, *obs.columns, place="place")),
        "filter_result": lambda spark, sf: srv.filter_result(agg.yearly(fx.obs(spark, sf)), CITIES, YEARS),
        "filter_city": lambda spark, sf: srv.filter_result(agg.decade(fx.obs(spark, sf)), CITIES, YEARS),
        "filter_options": _on_obs(lambda obs: srv.filter_options(agg.rankings(obs), agg.yearly(obs))),
        "year_range": _on_obs(lambda obs: srv.year_range(agg.yearly(obs))),
        "kpis": _on_obs(lambda obs: srv.kpis(agg.rankings(obs))),
        "map_points": lambda spark, sf: srv.map_points(agg.rankings(fx.obs(spark, sf)), fx.coords(spark, sf)),
        "month_heatmap": lambda spark, sf: stable(
            srv.month_heatmap(agg.monthly(fx.obs(spark, sf))), *srv.MONTH_NAMES),
        "seasonal_ordered": _on_obs(lambda obs: srv.seasonal_ordered(agg.seasonal(obs))),
        "peak_table": _on_obs(lambda obs: srv.peak_table(tmp.peak_month(obs))),
        "history_forecast": lambda spark, sf: stable(
            srv.history_forecast(agg.yearly(fx.obs(spark, sf)), _projected(spark, sf), years=YEARS), "uhi"),
        "alert_counts": lambda spark, sf: srv.alert_counts(_alerts(spark, sf)),
        "alerts_head": lambda spark, sf: srv.alerts_head(_alerts(spark, sf), 100),
        "extreme_head": _on_obs(lambda obs: srv.extreme_head(hot.extreme_heat(obs), 50)),
        "pixel_period": lambda spark, sf: pix.select_period(
            fx.pixels(spark, sf), "1998-04-01", "1998-05-01", ["LST_Day_1km"]),
        "pixel_clean": _celsius,
        "pixel_stats": lambda spark, sf: pix.collection_stats(fx.pixels(spark, sf)),
        "pixel_period_mean": pixel_period_mean,
        "pixel_monthly": pixel_monthly,
        "pixel_composite": lambda spark, sf: stable(_composite(spark, sf), "LST_Day_C", "LST_Night_C"),
        "month_gaps": lambda spark, sf: pix.month_gaps(_composite(spark, sf).filter("month NOT IN (2, 7)"), PIXEL_YEARS),
        "zonal_mean": _zonal_mean("rural"),
        "zonal_mean_urban": _zonal_mean("urban"),
        "zonal_series": lambda spark, sf: stable(
            pix.zonal_series(_zone_composite(spark, sf), PIXEL_YEARS), *SERIES),
        "zonal_series_filled": zonal_series_filled,
        "zonal_series_tiled": zonal_series_tiled,
        "zonal_series_weighted": zonal_series_weighted,
        "zones_date_line": zones_date_line,
        "zonal_per_image": lambda spark, sf: stable(
            pix.zonal_per_image(_celsius(spark, sf), _regions(spark, sf)), "LST_Urban", "LST_Rural", "UHI_Index"),
    }


def queries() -> dict[str, Query]:
    if corpus_queries is None:
        return library_queries()
    return library_queries() | corpus_queries.QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    if corpus_queries is None:
        return library_sql()
    whole = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return library_sql() | corpus_queries.ORACLE_SQL | whole


def entry(spark: SparkSession) -> DataFrame:
    """Heat alerts on the smallest tables."""
    return _alerts(spark, SMOKE_DIR)
