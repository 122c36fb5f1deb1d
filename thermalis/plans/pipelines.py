"""Whole analyses. Each reads its input as few times as it can, through settled intermediate tables.

Results are lazy DataFrames, but for the small shared tables (thresholds, floors, month sums), which are settled
here, and places in an order.
"""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from thermalis.functions.fixed import EXTREME_HEAT_C, MISSING_C
from thermalis.operators import aggregates as agg
from thermalis.operators import features as feat
from thermalis.operators import forecast as fc
from thermalis.operators import hotspots as hot
from thermalis.operators import pixels as pix
from thermalis.operators import serving as srv
from thermalis.operators import temporal as tmp
from thermalis.operators.ingest import clean
from thermalis.schema import SERVED
from thermalis.sources import Publication, clean_export, read_obs, read_raw, scratch_run, settle, write_obs

Results = dict[str, DataFrame]


def build_observations(spark: SparkSession, path, sentinel: float | None = None) -> DataFrame:
    """Clean observations of all CSV exports under a path."""
    return clean(read_raw(spark, path), sentinel)


def settled_cells(obs: DataFrame) -> DataFrame:
    """The month-level sums as a table: one scan that serves every grouped report."""
    return settle(agg.cells(obs), "cells")


def core_analysis(source: DataFrame) -> Results:
    """The five grouped reports, from observations or cells."""
    source = source if "n_rows" in source.columns else settled_cells(source)
    return {
        "uhi_monthly": agg.monthly(source),
        "uhi_yearly": agg.yearly(source),
        "uhi_seasonal": agg.seasonal(source),
        "uhi_decade": agg.decade(source),
        "city_rankings": agg.rankings(source),
    }


def settled_thresholds(obs: DataFrame) -> DataFrame:
    return settle(hot.thresholds(obs), "thresholds")


def alert_reports(alerts: DataFrame) -> Results:
    """Both alert reports from one pass over the alerts."""
    pooled = settle(hot.hotspot_cells(alerts), "alert-cells")
    return {
        "hotspot_summary": hot.hotspot_summary(pooled),
        "monthly_hotspot_freq": hot.hotspot_monthly(pooled),
    }


def settled_floors(source: DataFrame, k: int = 10) -> DataFrame:
    return settle(hot.event_floors(source, k), "floors")


def hotspot_tables(obs: DataFrame, cells: DataFrame | None = None, limit_c: float = EXTREME_HEAT_C,
                   k: int = 10) -> Results:
    """Thresholds, alerts, extreme heat and top events. Settled cells, if at hand, spare a scan."""
    limits = settled_thresholds(obs)
    floors = settled_floors(obs if cells is None else cells, k)
    return {
        "uhi_thresholds": limits,
        "hotspot_alerts": hot.hotspots(obs, limits),
        "extreme_heat_events": hot.extreme_heat(obs, limit_c),
        "top_uhi_events": hot.top_events(obs, k, floors),
    }


def hotspot_analysis(obs: DataFrame, cells: DataFrame | None = None, limit_c: float = EXTREME_HEAT_C,
                     k: int = 10) -> Results:
    """The hotspot tables and the reports of the alerts.

    A job that writes the alerts anyway takes ``alert_reports`` from the written table instead.
    """
    tables = hotspot_tables(obs, cells, limit_c, k)
    return {**tables, **alert_reports(tables["hotspot_alerts"])}


def temporal_analysis(source: DataFrame) -> Results:
    """Change, trend, seasons by decade, peak months and moving averages, from observations or cells."""
    source = source if "n_rows" in source.columns else settled_cells(source)
    base = agg.yearly_base(source)
    return {
        "uhi_yoy_trends": tmp.yoy(base),
        "uhi_rate_of_change": tmp.trend_rate(base),
        "seasonal_evolution": agg.seasonal_decade(source),
        "peak_months": tmp.peak_month(source),
        "uhi_moving_avg": tmp.moving_avg(base),
    }


@dataclass
class Forecast:
    model: PipelineModel
    results: Results
    scored: DataFrame


def forecast_pipeline(source: DataFrame, trend: DataFrame | None = None, leak_free: bool = False,
                      keep_unknown: bool = False, partitions: int = fc.PARTITIONS,
                      max_bins: int = fc.MAX_BINS) -> Forecast:
    """Features, model, test scores and the forecast. The trend may be one published earlier.

    ``partitions`` and ``max_bins`` are those of ``fit_forecaster``.
    """
    if trend is None:
        source = source if "n_rows" in source.columns else settled_cells(source)
        trend = tmp.trend_rate(agg.yearly_base(source))
    features = settle(feat.monthly_features(source, leak_free), "features")
    train, test = feat.time_split(features)
    model = fc.fit_forecaster(train, keep_unknown, partitions, max_bins)
    scored = model.transform(test)
    predicted = fc.forecast(model, fc.forecast_inputs(features, trend))
    return Forecast(model, {
        "test_predictions": fc.test_predictions(scored),
        "metrics": fc.evaluate(scored),
        "prediction_errors": fc.prediction_errors(scored),
        "uhi_forecast_2025_2030": predicted,
        "forecast_summary": fc.forecast_summary(predicted),
        "feature_importance": fc.importances(model, source.sparkSession),
    }, scored)


def serving_views(results: Results, cities=None, years=None, coords: DataFrame | None = None) -> Results:
    """The tables behind a dashboard page, from loaded results by short name."""
    chosen = {key: srv.filter_result(results[key], cities, years) for key in SERVED}
    city_only = {key: srv.filter_result(results[key], cities) for key in SERVED}
    return {
        "options": srv.filter_options(results["rankings"], results["yearly"]),
        "year_range": srv.year_range(results["yearly"]),
        "kpis": srv.kpis(results["rankings"]),
        "rankings": srv.presented(results["rankings"], "city", desc="avg_uhi"),
        "rates": srv.presented(results["rate_of_change"], "city", desc="rate_per_decade_c"),
        "yearly": chosen["yearly"],
        "moving_avg": chosen["moving_avg"],
        "decade": city_only["decade"],
        "map_points": srv.map_points(city_only["rankings"], coords),
        "month_heatmap": srv.month_heatmap(results["monthly"], cities, years),
        "seasonal": srv.seasonal_ordered(results["seasonal"], cities),
        "temperatures": city_only["rankings"].select("city", "avg_urban_temp", "avg_night_temp"),
        "peak_table": srv.peak_table(results["peak_months"], cities),
        "history_forecast": srv.presented(
            srv.history_forecast(results["yearly"], results["forecast"], cities, years), "city", "year"),
        "alert_counts": srv.alert_counts(results["hotspots"], cities, years),
        "alerts": srv.filter_result(results["hotspots"], cities, years),
        "extreme": srv.filter_result(results["extreme_heat"], cities, years),
    }


def pixels_to_observations(px: DataFrame, regions: DataFrame, years: tuple[int, int],
                           fill: float | None = MISSING_C, footprint: tuple[float, float] | None = None) -> DataFrame:
    """Raw pixels of whole years to monthly rows per city, as the raw exports hold them.

    With ``fill`` every region has a row for every month, also one without pixels. With the pixels' footprint, pixels
    on the edge of a zone count by their share in it. A tiled pixel table is read only where regions are.
    """
    covered = settle(pix.region_cells(regions, footprint=footprint or (0.0, 0.0)), "region-cells")
    composite = settle(pix.zone_composite(pix.to_celsius(pix.qa_mask(px)), covered, years, footprint=footprint), "composite")
    return pix.zonal_series(composite, years, fill, regions)


def publish(spark: SparkSession, raw_path, obs_path: str, out: str, fmt: str = "csv",
            sentinel: float | None = None, partitions: int = fc.PARTITIONS,
            max_bins: int = fc.MAX_BINS) -> PipelineModel:
    """Everything from CSV exports to the published tables under ``out``; returns the fitted model.

    Readers of ``out`` see the new tables together once all are written. No scratch table is left.
    """
    write_obs(build_observations(spark, raw_path, sentinel), obs_path)
    obs = read_obs(spark, obs_path)
    with scratch_run(spark):
        source = settled_cells(obs)
        temporal = temporal_analysis(source)
        future = forecast_pipeline(source, temporal["uhi_rate_of_change"], partitions=partitions, max_bins=max_bins)
        tables = {
            "uhi_all_clean": clean_export(obs),
            **core_analysis(source),
            **hotspot_tables(obs, source),
            **temporal,
            **future.results,
        }
        publication = Publication(spark, out, fmt)
        written = {name: publication.write(name, table) for name, table in tables.items()}
        for name, table in alert_reports(written["hotspot_alerts"]).items():
            publication.write(name, table)
        publication.commit()
    return future.model
