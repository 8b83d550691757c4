"""sensorloom: sensor-reading key figures as plain Spark DataFrame code."""

__version__ = "0.1.0"
