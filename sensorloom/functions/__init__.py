"""Column expressions shared by the operators."""

from sensorloom.functions.columns import day_number, day_text, event_time, is_faulty, utc_day, with_day

__all__ = ["day_number", "day_text", "event_time", "is_faulty", "utc_day", "with_day"]
