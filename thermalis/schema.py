"""Table schemas."""

from pyspark.sql.types import (
    DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

S, I, L, D, DT = StringType(), IntegerType(), LongType(), DoubleType(), DateType()


def _table(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


MEASURES = ["LST_Day_Urban", "LST_Day_Rural", "LST_Night_Urban", "UHI_Index"]

# One row per city and day, °C.
OBSERVATIONS = _table(city=S, date=DT, year=I, month=I, day_of_year=I, LST_Day_Urban=D,
                      LST_Day_Rural=D, LST_Night_Urban=D, UHI_Index=D)

# One row per image and pixel, raw digital numbers.
PIXELS = _table(t=TimestampNTZType(), lon=D, lat=D, QC_Day=I, LST_Day_1km=I, LST_Night_1km=I)

# One urban rectangle per city, degrees.
REGIONS = _table(city=S, x0=D, y0=D, x1=D, y1=D)

COORDS = _table(city=S, lat=D, lon=D)

_CANONICAL = dict(date=DT, month=I, day_of_year=I, LST_Day_Urban=D, LST_Day_Rural=D,
                  LST_Night_Urban=D, UHI_Index=D, city=S, year=I)

# Published result tables, name -> schema.
RESULTS = {
    "uhi_all_clean": OBSERVATIONS,
    "uhi_monthly": _table(city=S, year=I, month=I, avg_uhi=D, avg_urban_lst=D, avg_rural_lst=D,
                          avg_night_lst=D, min_uhi=D, max_uhi=D, observations=L),
    "uhi_yearly": _table(city=S, year=I, avg_uhi=D, avg_urban_lst=D, avg_rural_lst=D,
                         avg_night_lst=D, std_uhi=D, min_uhi=D, max_uhi=D, observations=L),
    "uhi_seasonal": _table(city=S, season=S, avg_uhi=D, avg_urban_lst=D, avg_rural_lst=D,
                           std_uhi=D, observations=L),
    "uhi_decade": _table(city=S, decade=S, avg_uhi=D, avg_urban_lst=D, avg_rural_lst=D,
                         avg_night_lst=D, std_uhi=D, observations=L),
    "city_rankings": _table(city=S, avg_uhi=D, peak_uhi=D, avg_urban_temp=D, avg_night_temp=D,
                            total_observations=L),
    "uhi_thresholds": _table(city=S, p50_uhi=D, p75_uhi=D, p90_uhi=D, p95_uhi=D,
                             p90_urban_lst=D, p95_urban_lst=D),
    "hotspot_alerts": _table(city=S, date=DT, year=I, month=I, urban_temp_c=D, rural_temp_c=D,
                             uhi_index=D, threshold_p90=D, severity=S),
    "monthly_hotspot_freq": _table(city=S, month=I, hotspot_count=L, avg_uhi=D),
    "extreme_heat_events": _table(**_CANONICAL),
    "top_uhi_events": _table(**_CANONICAL, rank=I),
    "uhi_yoy_trends": _table(city=S, year=I, avg_uhi=D, avg_urban_lst=D, obs=L, prev_year_uhi=D,
                             yoy_change=D, trend=S),
    "uhi_rate_of_change": _table(city=S, slope_per_year=D, rate_per_decade_c=D, r_squared=D,
                                 first_year_uhi=D, last_year_uhi=D, overall_change=D, trend=S),
    "seasonal_evolution": _table(city=S, season=S, decade=S, avg_uhi=D, avg_urban_lst=D, obs=L),
    "peak_months": _table(city=S, peak_month=I, peak_uhi=D),
    "uhi_moving_avg": _table(city=S, year=I, avg_uhi=D, moving_avg_5yr=D),
    "test_predictions": _table(city=S, year=I, month=I, actual_uhi=D, predicted_uhi=D),
    "uhi_forecast_2025_2030": _table(city=S, year=I, month=I, predicted_uhi=D),
}

# Short names under which a reader asks for published tables.
SERVED = {
    "all_clean": "uhi_all_clean",
    "monthly": "uhi_monthly",
    "yearly": "uhi_yearly",
    "seasonal": "uhi_seasonal",
    "decade": "uhi_decade",
    "rankings": "city_rankings",
    "rate_of_change": "uhi_rate_of_change",
    "hotspots": "hotspot_alerts",
    "extreme_heat": "extreme_heat_events",
    "peak_months": "peak_months",
    "moving_avg": "uhi_moving_avg",
    "forecast": "uhi_forecast_2025_2030",
    "test_predictions": "test_predictions",
    "seasonal_evolution": "seasonal_evolution",
    "yoy_trends": "uhi_yoy_trends",
}
