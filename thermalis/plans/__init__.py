from thermalis.plans.pipelines import (
    Forecast, alert_reports, build_observations, core_analysis, forecast_pipeline, hotspot_analysis,
    hotspot_tables, pixels_to_observations, publish, serving_views, settled_cells, settled_floors,
    settled_thresholds, temporal_analysis,
)

__all__ = [
    "Forecast", "alert_reports", "build_observations", "core_analysis", "forecast_pipeline", "hotspot_analysis",
    "hotspot_tables", "pixels_to_observations", "publish", "serving_views", "settled_cells", "settled_floors",
    "settled_thresholds", "temporal_analysis",
]
