from thermalis.functions.labels import (
    decade_code, decade_label, marker_color, marker_radius, month_name, season_code,
    season_label, season_order, severity, yoy_trend,
)
from thermalis.functions.numbers import mean_of, rnd, rnd_rows

__all__ = [
    "decade_code", "decade_label", "marker_color", "marker_radius", "mean_of", "month_name",
    "rnd", "rnd_rows", "season_code", "season_label", "season_order", "severity", "yoy_trend",
]
