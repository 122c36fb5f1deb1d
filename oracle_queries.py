"""DuckDB SQL for the registered queries, written from the definitions and not from the Spark plans."""

import re

from thermalis.fixtures import DUCK, OBS_SQL, PIXELS_SQL, REGIONS_SQL

CITIES = ["NATION_1", "NATION_3", "NATION_7", "NATION_12", "NATION_20"]
YEARS = (2004, 2016)
PIXEL_YEARS = (1995, 2001)


def r(value: str, digits: int) -> str:
    """Half-up rounding on the decimal value."""
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def avgs(*columns) -> str:
    known = {"avg_uhi": ("UHI_Index", 4), "avg_urban_lst": ("LST_Day_Urban", 2),
             "avg_rural_lst": ("LST_Day_Rural", 2), "avg_night_lst": ("LST_Night_Urban", 2)}
    return ", ".join(f"{r(f'avg({known[c][0]})', known[c][1])} AS {c}" for c in columns)


STD = r("stddev_samp(UHI_Index)", 4) + " AS std_uhi"
MINMAX = f"{r('min(UHI_Index)', 4)} AS min_uhi, {r('max(UHI_Index)', 4)} AS max_uhi"
LSTS = ("avg_uhi", "avg_urban_lst", "avg_rural_lst", "avg_night_lst")
SEASON = """CASE WHEN month IN (3,4,5) THEN 'Pre-Monsoon' WHEN month IN (6,7,8,9) THEN 'Monsoon'
 WHEN month IN (10,11) THEN 'Post-Monsoon' ELSE 'Winter' END"""
SEASON_CODE = "CASE WHEN month IN (3,4,5) THEN 0 WHEN month IN (6,7,8,9) THEN 1 WHEN month IN (10,11) THEN 2 ELSE 3 END"
DECADE = """CASE WHEN year BETWEEN 2000 AND 2009 THEN '2000-2009' WHEN year BETWEEN 2010 AND 2019 THEN '2010-2019'
 ELSE '2020-2024' END"""
DECADE_CODE = "CASE WHEN year BETWEEN 2000 AND 2009 THEN 0 WHEN year BETWEEN 2010 AND 2019 THEN 1 ELSE 2 END"
CITY_IN = "city IN (" + ", ".join(f"'{c}'" for c in CITIES) + ")"
YEAR_IN = f"year BETWEEN {YEARS[0]} AND {YEARS[1]}"
PREV = "PARTITION BY city ORDER BY year NULLS FIRST, month NULLS FIRST"
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
MONTH_NAME = "CASE {0} " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(MONTHS, 1)) + " END"
def distance(lon: str = "lon", lat: str = "lat") -> str:
    """Great-circle metres from a place to the nearest point of the rectangle in degrees."""
    return f"""2*6371008.8::DOUBLE*asin(sqrt(
  pow(sin((radians(greatest(least({lat},y1),y0))-radians({lat}))/2),2)
  +cos(radians({lat}))*cos(radians(greatest(least({lat},y1),y0)))
   *pow(sin((radians(greatest(least({lon},x1),x0))-radians({lon}))/2),2)))"""


DISTANCE = distance()


def features(frame: str) -> str:
    return f"""SELECT city, year, month, avg_uhi, avg_urban_lst, avg_rural_lst, avg_night_lst,
 CAST({SEASON_CODE} AS INT) AS season, CAST({DECADE_CODE} AS INT) AS decade,
 coalesce(lag(avg_uhi,1) OVER ({PREV}), 0) AS prev_month_uhi,
 coalesce(lag(avg_uhi,12) OVER ({PREV}), 0) AS prev_year_uhi,
 coalesce({r(f'avg(avg_uhi) OVER ({PREV} ROWS BETWEEN {frame})', 4)}, 0) AS rolling_3m_uhi
FROM monthly_base"""


def filled(name: str, zone: str, band: str) -> str:
    """Zonal mean in which every pixel without a value counts as -9999."""
    return f"coalesce(avg(CASE WHEN zone='{zone}' THEN coalesce({band}, -9999::DOUBLE) END), -9999::DOUBLE) AS {name}"


def weighted(name: str, zone: str, band: str) -> str:
    """Weighted zonal mean in which every pixel without a value counts as -9999."""
    w = f"CASE WHEN zone='{zone}' THEN w END"
    return f"coalesce(sum({w}*coalesce({band}, -9999::DOUBLE))/sum({w}), -9999::DOUBLE) AS {name}"


CTES = {
    "obs": OBS_SQL.format(**DUCK),
    "pixels": PIXELS_SQL.format(**DUCK),
    "regions": REGIONS_SQL.format(**DUCK),
    "coords": "SELECT city, (y0+y1)/2 AS lat, (x0+x1)/2 AS lon FROM regions",
    "monthly": f"SELECT city, year, month, {avgs(*LSTS)}, {MINMAX}, count(*) AS observations FROM obs GROUP BY ALL",
    "yearly": f"SELECT city, year, {avgs(*LSTS)}, {STD}, {MINMAX}, count(*) AS observations FROM obs GROUP BY ALL",
    "seasonal": f"""SELECT city, {SEASON} AS season, {avgs(*LSTS[:3])}, {STD}, count(*) AS observations
FROM obs GROUP BY ALL""",
    "decades": f"SELECT city, {DECADE} AS decade, {avgs(*LSTS)}, {STD}, count(*) AS observations FROM obs GROUP BY ALL",
    "rankings": f"""SELECT city, {r('avg(UHI_Index)', 4)} AS avg_uhi, {r('max(UHI_Index)', 4)} AS peak_uhi,
 {r('avg(LST_Day_Urban)', 2)} AS avg_urban_temp, {r('avg(LST_Night_Urban)', 2)} AS avg_night_temp,
 count(*) AS total_observations FROM obs GROUP BY city""",
    "yearly_base": f"SELECT city, year, {avgs('avg_uhi', 'avg_urban_lst')}, count(*) AS obs FROM obs GROUP BY ALL",
    "monthly_base": f"SELECT city, year, month, {avgs(*LSTS)} FROM obs GROUP BY ALL",
    "climatology": f"SELECT city, month, {avgs('avg_uhi')} FROM obs GROUP BY ALL",
    "thresholds": "SELECT city, " + ", ".join(
        f"{r(f'quantile_disc({m}, 0.{p})', d)} AS {name}" for name, m, p, d in (
            ("p50_uhi", "UHI_Index", 50, 4), ("p75_uhi", "UHI_Index", 75, 4), ("p90_uhi", "UHI_Index", 90, 4),
            ("p95_uhi", "UHI_Index", 95, 4), ("p90_urban_lst", "LST_Day_Urban", 90, 2),
            ("p95_urban_lst", "LST_Day_Urban", 95, 2))) + " FROM obs GROUP BY city",
    "hotspots": f"""SELECT o.city, date, year, month, {r('LST_Day_Urban', 2)} AS urban_temp_c,
 {r('LST_Day_Rural', 2)} AS rural_temp_c, {r('UHI_Index', 4)} AS uhi_index, p90_uhi AS threshold_p90,
 CASE WHEN UHI_Index > p90_uhi*1.5::DOUBLE THEN 'CRITICAL' WHEN UHI_Index > p90_uhi*1.2::DOUBLE THEN 'HIGH'
  ELSE 'MODERATE' END AS severity
FROM obs o JOIN thresholds t ON o.city=t.city WHERE UHI_Index > p90_uhi""",
    "extreme": "SELECT * FROM obs WHERE LST_Day_Urban > 45",
    "yoy": f"""SELECT *, CASE WHEN yoy_change > 0.1::DOUBLE THEN '↑ Increasing'
  WHEN yoy_change < -0.1::DOUBLE THEN '↓ Decreasing' ELSE '→ Stable' END AS trend
FROM (SELECT *, {r('avg_uhi-prev_year_uhi', 4)} AS yoy_change
 FROM (SELECT *, lag(avg_uhi) OVER (PARTITION BY city ORDER BY year NULLS FIRST) AS prev_year_uhi FROM yearly_base) a) b""",
    "trend_rate": f"""SELECT city, {r('slope', 6)} AS slope_per_year, {r('slope*10', 4)} AS rate_per_decade_c,
 {r('CASE WHEN spread=0 THEN 0 ELSE r2 END', 4)} AS r_squared, {r('first', 4)} AS first_year_uhi,
 {r('last', 4)} AS last_year_uhi, {r('last-first', 4)} AS overall_change,
 CASE WHEN slope > 0 THEN 'Warming' ELSE 'Cooling' END AS trend
FROM (SELECT city, regr_slope(avg_uhi, year) AS slope, regr_r2(avg_uhi, year) AS r2, var_pop(avg_uhi) AS spread,
 arg_min(avg_uhi, year) AS first, arg_max(avg_uhi, year) AS last FROM yearly_base GROUP BY city
 HAVING count(avg_uhi) >= 5) f""",
    "peaks": """SELECT city, month AS peak_month, avg_uhi AS peak_uhi FROM (SELECT *, row_number() OVER
 (PARTITION BY city ORDER BY avg_uhi DESC NULLS LAST, month NULLS FIRST) AS rn FROM climatology) p WHERE rn=1""",
    "features": features("2 PRECEDING AND CURRENT ROW"),
    "forecast_base": """SELECT city, avg(avg_urban_lst) AS base_urban, avg(avg_rural_lst) AS base_rural,
 avg(avg_night_lst) AS base_night FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY year DESC NULLS LAST,
 month DESC NULLS LAST) AS back FROM features) f WHERE back <= 24 GROUP BY city""",
    "month_base": "SELECT city, month, avg(avg_uhi) AS base_uhi FROM features GROUP BY ALL",
    "grid": """SELECT city, CAST(y AS INT) AS year, CAST(m AS INT) AS month
FROM (SELECT DISTINCT city FROM features) c, range(2025, 2031) a(y), range(1, 13) b(m)""",
    "inputs": f"""SELECT city, year, month, CAST({SEASON_CODE} AS INT) AS season, 2 AS decade,
 {r('base_urban+(year-2024)*0.20::DOUBLE', 2)} AS avg_urban_lst,
 {r('base_rural+(year-2024)*0.15::DOUBLE', 2)} AS avg_rural_lst,
 {r('base_night+(year-2024)*0.10::DOUBLE', 2)} AS avg_night_lst,
 {r('b+s*(year-2024)', 4)} AS prev_month_uhi, {r('b+s*(year-2025)', 4)} AS prev_year_uhi,
 {r('b+s*(year-2024)', 4)} AS rolling_3m_uhi, 0::DOUBLE AS avg_uhi
FROM (SELECT g.*, base_urban, base_rural, base_night, coalesce(base_uhi, 0) AS b, coalesce(slope_per_year, 0) AS s
 FROM grid g LEFT JOIN forecast_base f ON g.city=f.city LEFT JOIN trend_rate t ON g.city=t.city
 LEFT JOIN month_base m ON g.city=m.city AND g.month=m.month) j""",
    # Stand-ins for model output, so that the operators behind it can be checked by value.
    "projected": "SELECT city, year, month, prev_month_uhi AS predicted_uhi FROM inputs",
    "naive": "SELECT *, prev_month_uhi AS prediction FROM features WHERE year >= 2023",
    "celsius": """SELECT t, lon, lat,
 CASE WHEN QC_Day & 3 = 0 THEN LST_Day_1km*0.02::DOUBLE-273.15::DOUBLE END AS LST_Day_C,
 CASE WHEN QC_Day & 3 = 0 THEN LST_Night_1km*0.02::DOUBLE-273.15::DOUBLE END AS LST_Night_C FROM pixels""",
    "composite": """SELECT lon, lat, CAST(year(t) AS INT) AS year, CAST(month(t) AS INT) AS month,
 avg(LST_Day_C) AS LST_Day_C, avg(LST_Night_C) AS LST_Night_C FROM celsius GROUP BY ALL""",
    "calendar": f"""SELECT CAST(y AS INT) AS year, CAST(m AS INT) AS month
FROM range({PIXEL_YEARS[0]}, {PIXEL_YEARS[1] + 1}) a(y), range(1, 13) b(m)""",
    "located": f"""SELECT lon, lat, city, CASE WHEN lon BETWEEN x0 AND x1 AND lat BETWEEN y0 AND y1 THEN 'urban'
 ELSE 'rural' END AS zone FROM (SELECT DISTINCT lon, lat FROM pixels) p, regions
WHERE {DISTANCE} <= 20000""",
    # The share of a footprint of 0.01 degrees in the rectangle, and of its 4 x 4 points in the ring.
    "shares": f"""SELECT lon, lat, city,
 greatest(least(lon+0.01::DOUBLE/2, x1)-greatest(lon-0.01::DOUBLE/2, x0), 0)/0.01::DOUBLE
  *(greatest(least(lat+0.01::DOUBLE/2, y1)-greatest(lat-0.01::DOUBLE/2, y0), 0)/0.01::DOUBLE) AS urban,
 (SELECT count(*) FROM (SELECT lon+0.01::DOUBLE*((i+0.5)/4-0.5) AS sx, lat+0.01::DOUBLE*((j+0.5)/4-0.5) AS sy FROM range(4) a(i), range(4) b(j)) g
  WHERE NOT (sx BETWEEN x0 AND x1 AND sy BETWEEN y0 AND y1) AND {distance("sx", "sy")} <= 20000)/16::DOUBLE AS rural
FROM (SELECT DISTINCT lon, lat FROM pixels) p, regions
WHERE lon BETWEEN x0-0.5 AND x1+0.5 AND lat BETWEEN y0-0.5 AND y1+0.5""",
    "weights": """SELECT lon, lat, city, 'urban' AS zone, urban AS w FROM shares WHERE urban > 0 UNION ALL
SELECT lon, lat, city, 'rural', rural FROM shares WHERE rural > 0""",
    "east_pixels": """SELECT CASE WHEN lon+103.85::DOUBLE > 180 THEN lon+103.85::DOUBLE-360 ELSE lon+103.85::DOUBLE END AS lon,
 lat, LST_Day_C FROM celsius""",
    "east_regions": """SELECT city, a AS x0, y0, CASE WHEN b < a THEN b+360 ELSE b END AS x1, y1 FROM (SELECT city, y0, y1,
 CASE WHEN x0+103.85::DOUBLE > 180 THEN x0+103.85::DOUBLE-360 ELSE x0+103.85::DOUBLE END AS a,
 CASE WHEN x1+103.85::DOUBLE > 180 THEN x1+103.85::DOUBLE-360 ELSE x1+103.85::DOUBLE END AS b FROM regions) e""",
    # Every place is tried as it is and once around the globe in both directions.
    "east_zones": f"""SELECT lon, lat, city, min(CASE WHEN sx BETWEEN x0 AND x1 AND lat BETWEEN y0 AND y1 THEN -1 ELSE {distance("sx")} END) AS away
FROM (SELECT lon, lat, lon+turn AS sx FROM (SELECT DISTINCT lon, lat FROM east_pixels) p, (VALUES (-360), (0), (360)) t(turn)) q,
 east_regions WHERE sx BETWEEN x0-1 AND x1+1 GROUP BY ALL""",
    "per_zone": "SELECT c.*, city, zone FROM composite c JOIN located l ON c.lon=l.lon AND c.lat=l.lat",
}

ROUND_SERIES = ", ".join(f"{r(c, 6)} AS {c}" for c in ("LST_Day_Urban", "LST_Day_Rural", "LST_Night_Urban"))
SERIES_INDEX = r("LST_Day_Urban-LST_Day_Rural", 6) + " AS UHI_Index"

SQL = {
    "ingest_clean": "SELECT * FROM obs WHERE NOT (month = 2 AND day(date) = 29)",
    "ingest_year_month": f"""SELECT city, make_date(year, month, 1) AS date, year, month,
 CAST(dayofyear(make_date(year, month, 1)) AS INT) AS day_of_year, avg_urban_lst AS LST_Day_Urban,
 avg_rural_lst AS LST_Day_Rural, avg_night_lst AS LST_Night_Urban, avg_uhi AS UHI_Index FROM monthly""",
    "ingest_sentinel": "SELECT * FROM obs WHERE month <> 1",
    "obs_roundtrip": "SELECT * FROM obs",
    "by_city_roundtrip": "SELECT * FROM yearly",
    "results_roundtrip": """SELECT 'monthly' AS name, count(*) AS n FROM monthly UNION ALL
SELECT 'yearly', count(*) FROM yearly UNION ALL SELECT 'seasonal', count(*) FROM seasonal UNION ALL
SELECT 'decade', count(*) FROM decades UNION ALL SELECT 'rankings', count(*) FROM rankings UNION ALL
SELECT name, 0 FROM (VALUES ('all_clean'), ('rate_of_change'), ('hotspots'), ('extreme_heat'), ('peak_months'),
 ('moving_avg'), ('forecast'), ('test_predictions'), ('seasonal_evolution'), ('yoy_trends')) v(name)""",
    "clean_export": "SELECT * FROM obs",
    "row_counts": "SELECT count(*) AS records, count(DISTINCT city) AS cities FROM obs",
    "sql_views": f"""SELECT 'season' AS kind, {SEASON} AS label, count(*) AS n, {r('avg(UHI_Index)', 4)} AS avg_uhi
FROM obs GROUP BY ALL UNION ALL
SELECT 'decade', {DECADE}, count(*), {r('avg(UHI_Index)', 4)} FROM obs GROUP BY ALL UNION ALL
SELECT 'all', 'all', count(*), {r('avg(UHI_Index)', 4)} FROM obs""",
    "city_counts": "SELECT city, count(*) AS count FROM obs GROUP BY city",
    "monthly": "SELECT * FROM monthly",
    "yearly": "SELECT * FROM yearly",
    "seasonal": "SELECT * FROM seasonal",
    "decade": "SELECT * FROM decades",
    "rankings": "SELECT * FROM rankings",
    "yearly_base": "SELECT * FROM yearly_base",
    "seasonal_decade": f"""SELECT city, {SEASON} AS season, {DECADE} AS decade, {avgs('avg_uhi', 'avg_urban_lst')},
 count(*) AS obs FROM obs GROUP BY ALL""",
    "month_climatology": "SELECT * FROM climatology",
    "thresholds": "SELECT * FROM thresholds",
    "hotspots": "SELECT * FROM hotspots",
    "hotspot_summary": f"""SELECT city, severity, count(*) AS event_count, {r('avg(uhi_index)', 4)} AS avg_uhi,
 {r('avg(urban_temp_c)', 2)} AS avg_temp FROM hotspots GROUP BY ALL""",
    "hotspot_monthly": f"""SELECT city, month, count(*) AS hotspot_count, {r('avg(uhi_index)', 4)} AS avg_uhi
FROM hotspots GROUP BY ALL""",
    "extreme_heat": "SELECT * FROM extreme",
    "top_events": """SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY city ORDER BY UHI_Index DESC NULLS LAST,
 date NULLS FIRST, LST_Day_Urban NULLS FIRST, LST_Day_Rural NULLS FIRST, LST_Night_Urban NULLS FIRST) AS INT) AS rank
FROM obs) t WHERE rank <= 10""",
    "yoy": "SELECT * FROM yoy",
    "trend_rate": "SELECT * FROM trend_rate",
    "moving_avg": f"""SELECT city, year, avg_uhi, {r('''avg(avg_uhi) OVER (PARTITION BY city ORDER BY year NULLS FIRST
 ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)''', 4)} AS moving_avg_5yr FROM yearly_base""",
    "peak_month": "SELECT * FROM peaks",
    "features": "SELECT * FROM features",
    "features_leak_free": features("3 PRECEDING AND 1 PRECEDING"),
    "split_counts": """SELECT count(*) FILTER (WHERE year <= 2022) AS train_rows,
 count(*) FILTER (WHERE year >= 2023) AS test_rows FROM features""",
    "city_index": """SELECT city, CAST(row_number() OVER (ORDER BY count(*) DESC, city)-1 AS DOUBLE) AS city_index
FROM features WHERE year <= 2022 GROUP BY city""",
    "forecast_grid": "SELECT * FROM grid",
    "forecast_base": f"""SELECT city, {r('base_urban', 6)} AS base_urban, {r('base_rural', 6)} AS base_rural,
 {r('base_night', 6)} AS base_night FROM forecast_base""",
    "forecast_month_base": f"SELECT city, month, {r('base_uhi', 6)} AS base_uhi FROM month_base",
    "forecast_inputs": "SELECT * FROM inputs",
    "forecast_summary": "SELECT city, " + ", ".join(
        f'{r(f"avg(CASE WHEN year={y} THEN predicted_uhi END)", 4)} AS "{y}"' for y in range(2025, 2031))
        + " FROM projected GROUP BY city",
    "forecast_yearly": f"SELECT city, year, {r('avg(predicted_uhi)', 6)} AS uhi FROM projected GROUP BY ALL",
    "evaluate": f"""SELECT {r('avg(abs(avg_uhi-prediction))', 4)} AS mae,
 {r('sqrt(avg((avg_uhi-prediction)*(avg_uhi-prediction)))', 4)} AS rmse,
 {r('1-sum((avg_uhi-prediction)*(avg_uhi-prediction))/(var_pop(avg_uhi)*count(*))', 4)} AS r2 FROM naive""",
    "prediction_errors": f"""SELECT city, year, month, avg_uhi AS actual, {r('prediction', 4)} AS predicted,
 {r('abs(avg_uhi-prediction)', 4)} AS error FROM naive""",
    # A row with a null input is not scored.
    "ml_scored_rows": """SELECT city, year, month, avg_uhi AS actual_uhi FROM features WHERE year >= 2023
 AND avg_urban_lst IS NOT NULL AND avg_rural_lst IS NOT NULL AND avg_night_lst IS NOT NULL""",
    "ml_forecast_rows": """SELECT city, year, month FROM inputs
WHERE avg_urban_lst IS NOT NULL AND avg_rural_lst IS NOT NULL AND avg_night_lst IS NOT NULL""",
    "filter_result": f"SELECT * FROM yearly WHERE {CITY_IN} AND {YEAR_IN}",
    "filter_city": f"SELECT * FROM decades WHERE {CITY_IN}",
    "filter_options": """SELECT *, option = 'city' AND place <= 5 AS preselected FROM (
 SELECT option, value, CAST(row_number() OVER (PARTITION BY option ORDER BY value) AS INT) AS place
 FROM (SELECT DISTINCT 'city' AS option, city AS value FROM rankings UNION ALL
  SELECT DISTINCT 'year', CAST(year AS VARCHAR) FROM yearly) o) p""",
    "year_range": "SELECT min(year) AS first_year, max(year) AS last_year FROM yearly",
    "kpis": f"""SELECT (SELECT city FROM rankings ORDER BY avg_uhi DESC, city LIMIT 1) AS hottest_city,
 (SELECT max(avg_uhi) FROM rankings) AS hottest_uhi,
 (SELECT city FROM rankings ORDER BY avg_uhi, city LIMIT 1) AS coolest_city,
 (SELECT min(avg_uhi) FROM rankings) AS coolest_uhi,
 {r('avg(avg_urban_temp)', 1)} AS avg_urban_temp, {r('avg(avg_night_temp)', 1)} AS avg_night_temp FROM rankings""",
    "map_points": f"""SELECT k.city, lat, lon, avg_uhi,
 CASE WHEN avg_uhi > 0.3::DOUBLE THEN 'red' WHEN avg_uhi > 0 THEN 'orange' ELSE 'blue' END AS color,
 greatest(abs(avg_uhi)*15, 5::DOUBLE) AS radius,
 k.city || ': ' || printf('%.2f°C', {r('avg_uhi', 2)}) AS tooltip,
 k.city || chr(10) || 'UHI: ' || printf('%.2f°C', {r('avg_uhi', 2)}) || chr(10) || 'Urban: '
  || printf('%.1f°C', {r('avg_urban_temp', 1)}) || chr(10) || 'Peak: ' || printf('%.2f°C', {r('peak_uhi', 2)}) AS popup
FROM rankings k JOIN coords c ON k.city=c.city""",
    "month_heatmap": "SELECT city, " + ", ".join(
        f"{r(f'avg(CASE WHEN month={i} THEN avg_uhi END)', 6)} AS {m}" for i, m in enumerate(MONTHS, 1))
        + " FROM monthly GROUP BY city",
    "seasonal_ordered": """SELECT *, CASE season WHEN 'Pre-Monsoon' THEN 1 WHEN 'Monsoon' THEN 2 WHEN 'Post-Monsoon' THEN 3
 ELSE 4 END::BIGINT AS season_place FROM seasonal""",
    "peak_table": f"""SELECT city, {MONTH_NAME.format('peak_month')} AS "Peak Month", peak_uhi AS "Peak UHI (°C)"
FROM peaks""",
    "history_forecast": f"""SELECT city, year, avg_uhi AS uhi, 'Historical' AS type FROM yearly WHERE {YEAR_IN} UNION ALL
SELECT city, year, {r('avg(predicted_uhi)', 6)}, 'Forecast' FROM projected GROUP BY city, year""",
    "alert_counts": """SELECT count(*) FILTER (WHERE severity='CRITICAL') AS critical,
 count(*) FILTER (WHERE severity='HIGH') AS high, count(*) AS total FROM hotspots""",
    "alerts_head": """SELECT * FROM hotspots ORDER BY city NULLS FIRST, date NULLS FIRST, uhi_index NULLS FIRST,
 urban_temp_c NULLS FIRST, rural_temp_c NULLS FIRST LIMIT 100""",
    "extreme_head": """SELECT * FROM extreme ORDER BY city NULLS FIRST, date NULLS FIRST, UHI_Index NULLS FIRST,
 LST_Day_Urban NULLS FIRST, LST_Day_Rural NULLS FIRST, LST_Night_Urban NULLS FIRST LIMIT 50""",
    "hotspot_stream": "SELECT * FROM hotspots",
    "pixel_period": "SELECT t, lon, lat, LST_Day_1km FROM pixels WHERE t >= '1998-04-01' AND t < '1998-05-01'",
    "pixel_clean": "SELECT * FROM celsius",
    "pixel_stats": "SELECT count(DISTINCT t) AS images, CAST(min(t) AS DATE) AS first_date FROM pixels",
    "pixel_period_mean": f"""SELECT lon, lat, {r('avg(LST_Day_1km*0.02::DOUBLE-273.15::DOUBLE)', 6)} AS mean_day_c
FROM pixels WHERE t >= '1998-01-01' AND t < '1999-01-01' GROUP BY ALL""",
    "pixel_monthly": f"""SELECT lon, lat, year, month, {r('LST_Day_C', 6)} AS LST_Day_C, {r('LST_Night_C', 6)} AS LST_Night_C
FROM composite UNION ALL
SELECT lon, lat, year, month, -9999, -9999 FROM (SELECT DISTINCT lon, lat FROM pixels) p,
 (SELECT * FROM calendar EXCEPT SELECT DISTINCT year, month FROM composite) g""",
    "zonal_mean": f"""SELECT city, year, month, {r('avg(LST_Day_C)', 6)} AS LST_Day_C, {r('avg(LST_Night_C)', 6)} AS LST_Night_C
FROM per_zone WHERE zone='rural' GROUP BY ALL""",
    "zonal_series": f"""SELECT city, year, month, {ROUND_SERIES}, {SERIES_INDEX} FROM (SELECT city, year, month,
 avg(CASE WHEN zone='urban' THEN LST_Day_C END) AS LST_Day_Urban,
 avg(CASE WHEN zone='rural' THEN LST_Day_C END) AS LST_Day_Rural,
 avg(CASE WHEN zone='urban' THEN LST_Night_C END) AS LST_Night_Urban FROM per_zone GROUP BY ALL) z""",
    "zonal_series_filled": f"""SELECT city, year, month, {ROUND_SERIES}, {SERIES_INDEX} FROM (SELECT n.city, g.year, g.month,
 {filled('LST_Day_Urban', 'urban', 'LST_Day_C')}, {filled('LST_Day_Rural', 'rural', 'LST_Day_C')},
 {filled('LST_Night_Urban', 'urban', 'LST_Night_C')}
 FROM regions n CROSS JOIN calendar g LEFT JOIN located l ON l.city=n.city LEFT JOIN composite c
  ON c.lon=l.lon AND c.lat=l.lat AND c.year=g.year AND c.month=g.month GROUP BY ALL) z""",
    "pixel_composite": f"""SELECT lon, lat, year, month, {r('LST_Day_C', 6)} AS LST_Day_C, {r('LST_Night_C', 6)} AS LST_Night_C
FROM composite""",
    "month_gaps": """SELECT * FROM calendar EXCEPT SELECT DISTINCT year, month FROM composite WHERE month NOT IN (2, 7)""",
    "zonal_mean_urban": f"""SELECT city, year, month, {r('avg(LST_Day_C)', 6)} AS LST_Day_C, {r('avg(LST_Night_C)', 6)} AS LST_Night_C
FROM per_zone WHERE zone='urban' GROUP BY ALL""",
    "zonal_series_weighted": f"""SELECT city, year, month, {ROUND_SERIES}, {SERIES_INDEX} FROM (SELECT n.city, g.year, g.month,
 {weighted('LST_Day_Urban', 'urban', 'LST_Day_C')}, {weighted('LST_Day_Rural', 'rural', 'LST_Day_C')},
 {weighted('LST_Night_Urban', 'urban', 'LST_Night_C')}
 FROM regions n CROSS JOIN calendar g LEFT JOIN weights l ON l.city=n.city LEFT JOIN composite c
  ON c.lon=l.lon AND c.lat=l.lat AND c.year=g.year AND c.month=g.month GROUP BY ALL) z""",
    "zones_date_line": f"""SELECT city, CASE WHEN away = -1 THEN 'urban' ELSE 'rural' END AS zone, count(*) AS n,
 {r('avg(LST_Day_C)', 6)} AS mean_day_c FROM east_pixels p JOIN east_zones z ON p.lon=z.lon AND p.lat=z.lat
WHERE away <= 20000 GROUP BY ALL""",
    "zonal_per_image": f"""SELECT city, strftime(t, '%Y-%m-%d') AS date, {r('u', 6)} AS LST_Urban, {r('v', 6)} AS LST_Rural,
 {r('u-v', 6)} AS UHI_Index FROM (SELECT city, t, avg(CASE WHEN zone='urban' THEN LST_Day_C END) AS u,
 avg(CASE WHEN zone='rural' THEN LST_Day_C END) AS v
 FROM celsius c JOIN located l ON c.lon=l.lon AND c.lat=l.lat GROUP BY ALL) z""",
}


def _with(sql: str) -> str:
    """Prefix the tables that a query needs, in order of definition."""
    needed, todo = set(), [sql]
    while todo:
        text = todo.pop()
        for name in CTES:
            if name not in needed and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                needed.add(name)
                todo.append(CTES[name])
    parts = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in CTES if name in needed)
    return f"WITH {parts}\n{sql}" if parts else sql


def counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS name, count(*) AS n FROM {table}" for name, table in tables.items())


# Shares in ten-thousandths, as the definitions of the percentiles have them.
WANTED = {"p50_uhi": ("UHI_Index", 5000), "p75_uhi": ("UHI_Index", 7500), "p90_uhi": ("UHI_Index", 9000),
          "p95_uhi": ("UHI_Index", 9500), "p90_urban_lst": ("LST_Day_Urban", 9000), "p95_urban_lst": ("LST_Day_Urban", 9500)}
TEMPORAL = {"uhi_yoy_trends": "yoy", "uhi_rate_of_change": "trend_rate",
            "seasonal_evolution": f"(SELECT DISTINCT city, {SEASON}, {DECADE} FROM obs)", "peak_months": "peaks", "uhi_moving_avg": "yearly_base"}
SERVED_ROWS = {
    "options": "(SELECT DISTINCT city FROM rankings UNION ALL SELECT DISTINCT CAST(year AS VARCHAR) FROM yearly)",
    "year_range": "(SELECT 1)", "kpis": "(SELECT 1)", "rankings": "rankings", "rates": "trend_rate",
    "yearly": f"yearly WHERE {CITY_IN} AND {YEAR_IN}", "moving_avg": f"yearly_base WHERE {CITY_IN} AND {YEAR_IN}",
    "decade": f"decades WHERE {CITY_IN}", "map_points": f"rankings WHERE {CITY_IN}",
    "month_heatmap": f"(SELECT DISTINCT city FROM monthly WHERE {CITY_IN} AND {YEAR_IN})", "seasonal": f"seasonal WHERE {CITY_IN}",
    "temperatures": f"rankings WHERE {CITY_IN}", "peak_table": f"peaks WHERE {CITY_IN}",
    "history_forecast": f"""(SELECT city, year FROM yearly WHERE {CITY_IN} AND {YEAR_IN} AND avg_uhi IS NOT NULL UNION ALL
 SELECT DISTINCT city, year FROM projected WHERE {CITY_IN})""",
    "alert_counts": "(SELECT 1)", "alerts": f"hotspots WHERE {CITY_IN} AND {YEAR_IN}", "extreme": f"extreme WHERE {CITY_IN} AND {YEAR_IN}",
}
SCORED = "avg_urban_lst IS NOT NULL AND avg_rural_lst IS NOT NULL AND avg_night_lst IS NOT NULL"
OBS_ORDER = "city, date, year, month, day_of_year, LST_Day_Urban, LST_Day_Rural, LST_Night_Urban, UHI_Index"
PLACES = {
    "ordered_by_key": ("monthly", "city NULLS FIRST, year NULLS FIRST, month NULLS FIRST"),
    "ordered_by_measure": ("trend_rate", "rate_per_decade_c DESC NULLS LAST, city NULLS FIRST"),
    "ordered_history": (f"({SQL['history_forecast']}) h", "city, year"),
    "ordered_observations": ("obs", ", ".join(f"{c.strip()} NULLS FIRST" for c in OBS_ORDER.split(","))),
}
SQL |= {name: f"SELECT *, row_number() OVER (ORDER BY {order}) AS place FROM {table}" for name, (table, order) in PLACES.items()}
SQL |= {
    "threshold_ranks": " UNION ALL ".join(
        f"SELECT city, '{level}' AS level, count({m}) AS n, (count({m})*{share}+9999)//10000 AS wanted, true AS near FROM obs GROUP BY city"
        for level, (m, share) in WANTED.items()),
    # The model's own values are the other side: no row may be off.
    "forest_walk": f"SELECT count(*) AS n, 0::BIGINT AS n_off FROM features WHERE year >= 2023 AND {SCORED}",
    "forest_walk_forecast": f"SELECT count(*) AS n, 0::BIGINT AS n_off FROM inputs WHERE {SCORED}",
    "forest_importances": "SELECT 11::BIGINT AS n, 0::BIGINT AS n_off",
    "model_metrics": "SELECT 3::BIGINT AS n, 0::BIGINT AS n_off",
    "model_roundtrip": f"SELECT count(*) AS n, 0::BIGINT AS n_off FROM features WHERE year >= 2023 AND {SCORED}",
    "trend_readback": "SELECT * FROM trend_rate",
    "republished": counts({"uhi_yearly": f"yearly WHERE {CITY_IN}", "uhi_decade": "decades", "uhi_monthly": "(SELECT 1 WHERE false)"}),
    "hotspot_report": counts({
        "uhi_thresholds": "thresholds", "hotspot_alerts": "hotspots", "extreme_heat_events": "extreme",
        "top_uhi_events": "(SELECT row_number() OVER (PARTITION BY city) AS rn FROM obs QUALIFY rn <= 10)",
        "hotspot_summary": "(SELECT DISTINCT city, severity FROM hotspots)", "monthly_hotspot_freq": "(SELECT DISTINCT city, month FROM hotspots)"}),
    "temporal_report": counts(TEMPORAL),
    "serving_report": counts(SERVED_ROWS),
}
SQL["zonal_series_tiled"] = SQL["zonal_series"]


def oracle_sql() -> dict[str, str]:
    return {name: _with(sql) for name, sql in SQL.items()}
