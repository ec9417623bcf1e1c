"""Record layouts and the fixed values of the forecast-verification domain."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

# The providers, in the order in which their answers are nested in a document.
PROVIDERS = ["open_meteo", "openweathermap", "weatherapi", "weatherbit", "weatherstack"]
# The providers declared for forecasts.
FORECAST_PROVIDERS = ["open_meteo", "openweathermap", "weatherapi", "weatherbit"]
# Lead times in hours, and how far a forecast may lie from one.
LEAD_HOURS = [1, 3, 6, 12, 24, 48]
LEAD_HALF_WIDTH = 0.5
MAX_LEAD_HOURS = 48
# Compass sectors as (from degree, to degree, name), both ends included; the first match counts.
COMPASS = [
    (0, 22.5, "N"),
    (22.5, 67.5, "NE"),
    (67.5, 112.5, "E"),
    (112.5, 157.5, "SE"),
    (157.5, 202.5, "S"),
    (202.5, 247.5, "SW"),
    (247.5, 292.5, "W"),
    (292.5, 337.5, "NW"),
    (337.5, 360, "N"),
]
COMPASS_NAMES = ["N", "NE", "E", "SE", "S", "SW", "W", "NW", "Unknown"]
# End of validity of a version still in force; start of time for empty tables.
OPEN_END = dt.datetime(5999, 1, 1)
RAW_EPOCH = dt.datetime(1970, 1, 1)
ODS_EPOCH = dt.datetime(1900, 1, 1)
# Allowed forecast horizons of a request and the horizon used when none is given.
MIN_HOURS, MAX_HOURS, DEFAULT_HOURS = 1, 168, 24
# Allowed sizes of a history listing and the size used when none is given.
MIN_LIMIT, MAX_LIMIT, DEFAULT_LIMIT = 1, 100, 10
# The city dimension (latitude, longitude, city, country), with its one repeated
# row and its one city at two positions.
CITIES = [
    (55.75, 37.62, "Moscow", "Russia"),
    (59.93, 30.36, "Saint Petersburg", "Russia"),
    (55.03, 82.92, "Novosibirsk", "Russia"),
    (56.84, 60.65, "Yekaterinburg", "Russia"),
    (55.79, 49.12, "Kazan", "Russia"),
    (43.12, 131.89, "Vladivostok", "Russia"),
    (68.97, 33.08, "Murmansk", "Russia"),
    (46.96, 142.73, "Yuzhno-Sakhalinsk", "Russia"),
    (51.51, -0.13, "London", "United Kingdom"),
    (48.85, 2.35, "Paris", "France"),
    (52.52, 13.40, "Berlin", "Germany"),
    (40.42, -3.70, "Madrid", "Spain"),
    (41.90, 12.50, "Rome", "Italy"),
    (40.71, -74.01, "New York", "USA"),
    (34.05, -118.24, "Los Angeles", "USA"),
    (41.88, -87.63, "Chicago", "USA"),
    (25.76, -80.19, "Miami", "USA"),
    (43.65, -79.38, "Toronto", "Canada"),
    (43.07, 131.55, "Vladivostok", "Russia"),
    (59.93, 30.36, "Saint Petersburg", "Russia"),
]

# Where each extra reading of a current sample lies in the provider's own payload.
RAW_PATHS = {
    "pressure_hpa": {
        "openweathermap": "main.pressure",
        "weatherapi": "current.pressure_mb",
        "weatherbit": "data[0].pres",
        "weatherstack": "current.pressure",
    },
    "visibility_km": {
        "openweathermap": "visibility",
        "weatherapi": "current.vis_km",
        "weatherbit": "data[0].vis",
        "weatherstack": "current.visibility",
    },
    "feels_like_celsius": {
        "openweathermap": "main.feels_like",
        "weatherapi": "current.feelslike_c",
        "weatherbit": "data[0].app_temp",
        "weatherstack": "current.feelslike",
    },
    "wind_direction_degrees": {
        "openweathermap": "wind.deg",
        "weatherapi": "current.wind_degree",
        "weatherbit": "data[0].wind_dir",
        "weatherstack": "current.wind_degree",
        "open_meteo": "current_weather.winddirection",
    },
    "cloud_cover_percent": {
        "openweathermap": "clouds.all",
        "weatherapi": "current.cloudcover",
        "weatherbit": "data[0].clouds",
        "weatherstack": "current.cloudcover",
    },
    "uv_index": {
        "weatherapi": "current.uv",
        "weatherbit": "data[0].uv",
        "weatherstack": "current.uv_index",
    },
    "precipitation_mm": {
        "weatherapi": "current.precip_mm",
        "weatherbit": "data[0].precip",
        "weatherstack": "current.precip",
    },
}
# Fixed values: (output, provider) pairs reported in metres and wanted in kilometres.
METRES = {("visibility_km", "openweathermap")}

# Key of a forecast point for each output column beyond time, temperature, humidity and wind.
POINT_KEYS = {
    "pressure_hpa": "pressure_mb",
    "precipitation_mm": "precip_mm",
    "cloud_cover_percent": "cloud_cover",
    "visibility_km": "visibility_km",
    "uv_index": "uv_index",
    "feels_like_celsius": "feels_like_c",
    "wind_direction_degrees": "wind_degree",
    "weather_condition": "condition",
    "precipitation_probability": "precip_probability",
}

S, D, N = T.StringType(), T.DoubleType(), T.TimestampNTZType()


def struct_from_paths(paths) -> T.StructType:
    """The smallest schema, with text leaves, in which all of ``a.b`` / ``a[0].b`` paths exist."""
    tree: dict = {}
    for path in paths:
        node = tree
        for step in path.split("."):
            node = node.setdefault(step, {})

    def build(node: dict) -> T.StructType:
        fields = []
        for step, child in node.items():
            kind = build(child) if child else S
            if step.endswith("[0]"):
                fields.append(T.StructField(step[:-3], T.ArrayType(kind)))
            else:
                fields.append(T.StructField(step, kind))
        return T.StructType(fields)

    return build(tree)


CITY_SCHEMA = T.StructType(
    [
        T.StructField("latitude", D),
        T.StructField("longitude", D),
        T.StructField("city", S),
        T.StructField("country", S),
    ]
)

LANDING_CURRENT = T.StructType(
    [
        T.StructField("request_id", S),
        T.StructField("provider", S),
        T.StructField("latitude", D),
        T.StructField("longitude", D),
        T.StructField("fetched_at", N),
        T.StructField("payload", S),
    ]
)
LANDING_FORECAST = T.StructType(
    LANDING_CURRENT.fields[:4] + [T.StructField("hours", T.IntegerType())] + LANDING_CURRENT.fields[4:]
)


def document_schema(kind: str) -> T.StructType:
    """A stored request document; ``request`` and ``response`` are JSON text."""
    hours = [T.StructField("hours", T.IntegerType())] if kind == "forecast" else []
    return T.StructType(
        [
            T.StructField("_id", S),
            T.StructField("type", S),
            T.StructField("latitude", D),
            T.StructField("longitude", D),
            *hours,
            T.StructField("request", S),
            T.StructField("response", S),
            T.StructField("status_code", T.IntegerType()),
            T.StructField("error_message", S),
            T.StructField("created_at", N),
            T.StructField("updated_at", N),
        ]
    )


def raw_key(kind: str) -> str:
    return "weather_id" if kind == "current" else "forecast_id"


def raw_schema(kind: str) -> T.StructType:
    """A raw table: every version of every document, with its span of validity."""
    hours = [T.StructField("hours", T.IntegerType(), False)] if kind == "forecast" else []
    return T.StructType(
        [
            T.StructField("id", S, False),
            T.StructField(raw_key(kind), S, False),
            T.StructField("latitude", D, False),
            T.StructField("longitude", D, False),
            *hours,
            T.StructField("request", S),
            T.StructField("response", S),
            T.StructField("status_code", T.IntegerType()),
            T.StructField("created_at", N),
            T.StructField("updated_at", N),
            T.StructField("valid_from_dttm", N),
            T.StructField("valid_to_dttm", N, False),
        ]
    )


# The parts of a response that staging reads; numbers stay text until they are cast.
CURRENT_RESPONSE = T.StructType(
    [
        T.StructField(
            "samples",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("provider", S),
                        T.StructField("observation_time", S),
                        T.StructField("temperature_c", S),
                        T.StructField("humidity", S),
                        T.StructField("wind_speed_kph", S),
                        T.StructField("condition", S),
                        T.StructField(
                            "raw",
                            struct_from_paths(p for by in RAW_PATHS.values() for p in by.values()),
                        ),
                    ]
                )
            ),
        ),
        T.StructField("average_temperature_c", S),
        T.StructField("average_humidity", S),
    ]
)
FORECAST_RESPONSE = T.StructType(
    [
        T.StructField(
            "forecasts",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("provider", S),
                        T.StructField(
                            "points",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField(name, S)
                                        for name in [
                                            "time",
                                            "temperature_c",
                                            "humidity",
                                            "wind_speed_kph",
                                            *POINT_KEYS.values(),
                                        ]
                                    ]
                                )
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)
