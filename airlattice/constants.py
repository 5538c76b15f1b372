"""Domain values.

Everything in this module is a fixed value: results are only right when these
codes, limits and coordinates are exactly the published ones.
"""

# metric_id, metric_code, metric_name, unit
METRICS = [
    (1, "pm25", "PM2.5", "µg/m³"),
    (2, "pm10", "PM10", "µg/m³"),
    (3, "no2", "Nitrogen Dioxide", "µg/m³"),
    (4, "o3", "Ozone", "µg/m³"),
    (5, "co", "Carbon Monoxide", "µg/m³"),
    (6, "so2", "Sulfur Dioxide", "µg/m³"),
]

METRIC_CODES = [m[1] for m in METRICS]

# Metrics requested from stations when the caller names none.
REQUESTED_METRICS = ["pm25", "pm10", "no2", "o3"]

# Metrics not offered in reports.
HIDDEN_METRICS = ["so2", "co"]

# city_name, country, latitude, longitude, timezone
CITIES = [
    ("London", "GB", 51.5074, -0.1278, "Europe/London"),
    ("Paris", "FR", 48.8566, 2.3522, "Europe/Paris"),
    ("Berlin", "DE", 52.5200, 13.4050, "Europe/Berlin"),
    ("New York", "US", 40.7128, -74.0060, "America/New_York"),
    ("Tokyo", "JP", 35.6762, 139.6503, "Asia/Tokyo"),
]

# Valid range per metric, inclusive.
VALUE_RANGES = {
    "pm25": (0.0, 500.0),
    "pm10": (0.0, 1000.0),
    "no2": (0.0, 500.0),
    "o3": (0.0, 500.0),
}

# Valid range per weather column, inclusive; None leaves that side open.
WEATHER_RANGES = {
    "temperature_c": (-50.0, 50.0),
    "humidity_percent": (0.0, 100.0),
    "precipitation_mm": (0.0, None),
    "wind_speed_ms": (0.0, None),
    "wind_direction_deg": (0.0, 360.0),
}

# metric: (MODERATE above, HIGH above), both strict.
RISK_LIMITS = {
    "pm25": (15.0, 25.0),
    "pm10": (30.0, 50.0),
    "no2": (100.0, 200.0),
    "o3": (120.0, 180.0),
}
RISK_LEVELS = ["HIGH", "LOW", "MODERATE"]

WEATHER_COLUMNS = list(WEATHER_RANGES)

# Payload parameter -> warehouse column.
WEATHER_MAPPING = {
    "temperature_2m": "temperature_c",
    "relative_humidity_2m": "humidity_percent",
    "precipitation": "precipitation_mm",
    "wind_speed_10m": "wind_speed_ms",
    "wind_direction_10m": "wind_direction_deg",
}
AIR_FORECAST_MAPPING = {
    "pm2_5": "pm25",
    "pm10": "pm10",
    "ozone": "o3",
    "nitrogen_dioxide": "no2",
}

# Lower-cased unit spellings that already mean micrograms per cubic metre.
MICROGRAM_UNITS = ["µg/m³", "ug/m3", "ug/m^3", "micrograms per cubic meter"]
PPM_FACTOR = 1000.0

MAX_MISSING_RATIO = 0.3
MIN_POINTS_PER_DAY = 20
POINTS_PER_DAY = 24
MAX_AGE_HOURS = 24
Z_LIMIT = 3.0

MAX_RADIUS_M = 25_000
EARTH_RADIUS_M = 6_371_000.0

# Forecast model.
LAGS = [1, 2, 3, 6, 24]
MEANS = [3, 6, 24]
BASE_FEATURES = WEATHER_COLUMNS + ["pm10"]
BOOSTING = {"maxIter": 200, "maxDepth": 7, "stepSize": 0.05, "minInstancesPerNode": 5,
            "subsamplingRate": 0.8, "seed": 42}
