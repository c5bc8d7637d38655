"""Schemas and fixed values shared by the whole package.

Everything here is data, not logic: the raw tables have declared schemas and are never inferred, and the
index bounds, label rules and names must be exactly these for results to be right.
"""

from pyspark.sql import types as T


def _columns(*pairs):
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


_TEXT, _REAL, _TIME = T.StringType(), T.DoubleType(), T.TimestampNTZType()

# The eight hourly weather variables, in table order.
WEATHER_VARIABLES = [
    "temperature_2m",
    "relative_humidity_2m",
    "wind_speed_10m",
    "wind_direction_10m",
    "precipitation",
    "pressure_msl",
    "cloud_cover",
    "boundary_layer_height",
]

# Raw tables. Timestamps carry no zone and are UTC by convention.
READINGS = _columns(
    ("station_id", _TEXT),
    ("station_label", _TEXT),
    ("latitude", _REAL),
    ("longitude", _REAL),
    ("pollutant", _TEXT),
    ("timestamp", _TIME),
    ("value", _REAL),
    ("unit", _TEXT),
    ("ingested_at", _TIME),
)

WEATHER = _columns(
    ("location_name", _TEXT),
    ("latitude", _REAL),
    ("longitude", _REAL),
    ("timestamp", _TIME),
    *[(name, _REAL) for name in WEATHER_VARIABLES],
    ("ingested_at", _TIME),
)

# Landed documents, as the sensor and weather services send them.
SERIES_DOC = _columns(
    ("id", _TEXT),
    ("uom", _TEXT),
    (
        "station",
        _columns(
            ("properties", _columns(("id", _TEXT), ("label", _TEXT))),
            ("geometry", _columns(("coordinates", T.ArrayType(_REAL)))),
        ),
    ),
    ("parameters", _columns(("phenomenon", _columns(("label", _TEXT))))),
    ("values", T.ArrayType(_columns(("timestamp", T.LongType()), ("value", _REAL)))),
)

WEATHER_DOC = _columns(
    (
        "hourly",
        _columns(("time", T.ArrayType(_TEXT)), *[(name, T.ArrayType(_REAL)) for name in WEATHER_VARIABLES]),
    ),
)

# Fixed value: the name the readings' source goes by in the tables.
READINGS_SOURCE = "irceline"

# Fixed value: the unit of a series that names none.
DEFAULT_UNIT = "µg/m³"

# Text a series label must contain to be a series of that pollutant.
SERIES_LABELS = {
    "PM10": "Particulate Matter < 10",
    "PM2.5": "Particulate Matter < 2.5",
    "NO2": "Nitrogen dioxide",
    "O3": "Ozone",
    "SO2": "Sulphur dioxide",
    "CO": "Carbon monoxide",
    "BC": "Black Carbon",
}

# Pollutants taken in when none are named.
DEFAULT_POLLUTANTS = ["PM10", "PM2.5", "NO2", "O3"]

# Standard names a cleaned reading may carry.
POLLUTANTS = ["PM2.5", "PM10", "NO2", "O3", "SO2", "CO", "BC"]

# Fixed values: (standard name, patterns of which one must match, patterns of which none may match),
# tried in this order against the lower-case label.
LABEL_RULES = [
    ("PM2.5", ["%particulate%2.5%", "%pm2%"], []),
    ("PM10", ["%particulate%10%", "%pm10%"], []),
    ("NO2", ["%no2%", "%nitrogen dioxide%"], []),
    ("O3", ["%o3%", "%ozone%"], []),
    ("SO2", ["%so2%"], []),
    ("CO", ["%co%"], ["%cover%"]),
    ("BC", ["%bc%", "%black carbon%"], []),
]

# Inclusive upper bounds of bands 1 to 9 in µg/m³; anything above the last is band 10.
BAND_BOUNDS = {
    "PM2.5": [5, 10, 15, 25, 35, 45, 55, 65, 75],
    "PM10": [10, 20, 30, 40, 50, 60, 70, 80, 100],
    "NO2": [10, 20, 30, 50, 70, 100, 150, 200, 400],
    "O3": [20, 40, 60, 80, 100, 140, 180, 240, 380],
}

# Column suffix of each pollutant that has an index.
INDEXED = {"PM2.5": "pm25", "PM10": "pm10", "NO2": "no2", "O3": "o3"}

# Words for the index values 1 to 10, and for all else.
BAND_LABELS = {
    1: "Very Good",
    2: "Very Good",
    3: "Good",
    4: "Good",
    5: "Moderate",
    6: "Moderate",
    7: "Poor",
    8: "Poor",
    9: "Very Poor",
    10: "Horrible",
}
UNKNOWN_BAND = "Unknown"

# Map colours of the index values 1 to 10, and for all else.
BAND_COLOURS = {
    1: "#50C878",
    2: "#7CCD7C",
    3: "#FFD700",
    4: "#FFC125",
    5: "#FF8C00",
    6: "#FF6347",
    7: "#DC143C",
    8: "#B22222",
    9: "#8B0000",
    10: "#4B0000",
}
UNKNOWN_COLOUR = "#808080"

# Chart names of the pollutant columns.
SERIES_COLUMNS = {"PM2.5": "avg_pm25", "PM10": "avg_pm10", "NO₂": "avg_no2", "O₃": "avg_o3"}

# Weather locations as (name, latitude, longitude).
WEATHER_POINTS = [
    ("Brussels", 50.85, 4.35),
    ("Antwerp", 51.22, 4.40),
    ("Ghent", 51.05, 3.72),
    ("Liege", 50.63, 5.57),
    ("Charleroi", 50.41, 4.44),
    ("Bruges", 51.21, 3.22),
    ("Namur", 50.47, 4.87),
    ("Hasselt", 50.93, 5.34),
]

# Fixed value: Earth radius of the great-circle distance, in km.
EARTH_RADIUS_KM = 6371

# Columns that identify a station in both marts.
STATION_KEYS = ["station_id", "station_label", "station_lat", "station_lon", "data_source"]
