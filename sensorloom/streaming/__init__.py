"""Structured Streaming ingest."""

from sensorloom.streaming.daily import closed_event_counts, count_days, daily_event_counts, missed_event_counts
from sensorloom.streaming.delivery import (
    deliver_by_size_or_time,
    delivered_errors,
    drop_resent,
    ingest_once,
    read_delivered,
)
from sensorloom.streaming.ingest import ingest_bronze, ingest_errors

__all__ = [
    "closed_event_counts",
    "count_days",
    "daily_event_counts",
    "deliver_by_size_or_time",
    "delivered_errors",
    "drop_resent",
    "ingest_bronze",
    "ingest_errors",
    "ingest_once",
    "missed_event_counts",
    "read_delivered",
]
