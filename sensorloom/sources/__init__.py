"""Readers. All return the declared reading schema."""

from sensorloom.sources.bronze import compact_bronze, raw_path, read_bronze, write_bronze
from sensorloom.sources.events import readings_from_events
from sensorloom.sources.json_arrays import read_json_array
from sensorloom.sources.json_files import read_json

__all__ = ["compact_bronze", "raw_path", "read_bronze", "read_json", "read_json_array", "readings_from_events", "write_bronze"]
