"""Labels, bin edges, constants and lookup tables that results depend on."""

# The seasons in display order, with the months of each.
SEASON_MONTHS = {
    "Pre-Monsoon": (3, 4, 5),
    "Monsoon": (6, 7, 8, 9),
    "Post-Monsoon": (10, 11),
    "Winter": (12, 1, 2),
}
SEASON_ORDER = tuple(SEASON_MONTHS)

# Decade label -> first and last year. The last label also takes every other year.
DECADE_YEARS = {
    "2000-2009": (2000, 2009),
    "2010-2019": (2010, 2019),
    "2020-2024": (2020, 2024),
}

# Month names.
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

# Alert bands as multiples of the 90th percentile, extreme-heat limit in °C.
CRITICAL_FACTOR = 1.5
HIGH_FACTOR = 1.2
EXTREME_HEAT_C = 45.0

# Year-over-year bands in °C and their labels.
YOY_BAND = 0.1
YOY_UP, YOY_DOWN, YOY_FLAT = "↑ Increasing", "↓ Decreasing", "→ Stable"

# Index above which a map marker is red and orange, radius per °C and smallest radius.
MARKER_RED, MARKER_ORANGE = 0.3, 0.0
MARKER_SCALE, MARKER_LEAST = 15, 5.0

# Raw band scale and offset to °C, quality bits, missing marker, ring width.
DN_SCALE = 0.02
KELVIN_OFFSET = 273.15
QC_BITS = 3
MISSING_C = -9999.0
RING_M = 20000.0

# Forecast horizon, yearly drift in °C (urban, rural, night), last train year.
BASE_YEAR = 2024
FORECAST_YEARS = (2025, 2030)
DRIFT_C = (0.20, 0.15, 0.10)
TRAIN_UNTIL = 2022

# City -> (latitude, longitude) of the map marker.
CITY_COORDS = {
    "Delhi": (28.64, 77.10),
    "Mumbai": (19.08, 72.88),
    "Bangalore": (12.98, 77.60),
    "Chennai": (13.08, 80.24),
    "Hyderabad": (17.40, 78.47),
    "Kochi": (9.97, 76.30),
    "Pune": (18.58, 73.87),
    "Ahmedabad": (23.02, 72.60),
    "Kolkata": (22.60, 88.35),
    "Jaipur": (26.90, 75.80),
    "Surat": (21.20, 72.83),
}

# City -> urban rectangle (west, south, east, north) in degrees.
CITY_RECTANGLES = {
    "Delhi": (76.84, 28.40, 77.35, 28.88),
    "Mumbai": (72.77, 18.89, 73.00, 19.27),
    "Bangalore": (77.46, 12.83, 77.74, 13.14),
    "Chennai": (80.15, 12.92, 80.33, 13.23),
    "Hyderabad": (78.31, 17.27, 78.62, 17.54),
    "Kochi": (76.20, 9.85, 76.40, 10.10),
    "Pune": (73.75, 18.45, 73.98, 18.70),
    "Ahmedabad": (72.45, 22.90, 72.75, 23.15),
    "Kolkata": (88.20, 22.45, 88.50, 22.75),
    "Jaipur": (75.65, 26.75, 75.95, 27.05),
    "Surat": (72.70, 21.10, 72.95, 21.30),
}
