"""Generic event rows seen as readings."""

from pyspark.sql import DataFrame

# The mapping of location and status is made up: it only has to give every row a place and a state. `ts` has no time
# zone, and neither has the constant it is compared with, so the session's zone plays no part.
_COLUMNS = (
    "user_id AS sensor_id",
    "value AS temperature",
    "try_cast(get_json_object(props, '$.k') AS double) AS humidity",
    "named_struct('latitude', CAST(user_id % 15 AS double) - 7.0D,"
    " 'longitude', CAST(user_id % 12 AS double) * 10.0D) AS location",
    "CASE event_type WHEN 'error' THEN 'faulty' WHEN 'signup' THEN 'inactive' ELSE 'active' END AS status",
    "event_type",
    "timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts) AS `timestamp`",
    "CAST(event_id AS string) AS uuid",
)


def readings_from_events(events: DataFrame) -> DataFrame:
    """Readings from rows of (event_id, ts timestamp_ntz, user_id, event_type, value, props)."""
    return events.selectExpr(*_COLUMNS)
