"""The checks of each model: those on its columns, and the stricter ones on the marts."""

from aeroband.operators.quality import accepted_values, between, not_null, row_count, unique
from aeroband.schemas import POLLUTANTS

MODEL_CHECKS = {
    "staged_readings": lambda: [
        not_null("station_id"),
        not_null("pollutant"),
        accepted_values("pollutant", POLLUTANTS),
        not_null("measurement_value"),
    ],
    "staged_weather": lambda: [not_null("location_name"), not_null("measured_at")],
    "readings_with_weather": lambda: [not_null("station_id"), not_null("measured_at")],
    "daily_index": lambda: [not_null("station_id"), not_null("measurement_date"), not_null("belaqi_overall")],
    "station_summary": lambda: [unique("station_id"), not_null("station_id")],
}

# The index range, and the bounding box of the network.
MART_CHECKS = {
    "daily_index": lambda: [
        row_count(at_least=1),
        not_null("station_id"),
        not_null("measurement_date"),
        not_null("belaqi_overall"),
        between("belaqi_overall", 1, 10),
    ],
    "station_summary": lambda: [
        row_count(at_least=1),
        unique("station_id"),
        between("station_lat", 49.5, 51.6),
        between("station_lon", 2.3, 6.5),
    ],
}
