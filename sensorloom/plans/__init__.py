"""Jobs: bronze in, result tables out."""

from sensorloom.plans.jobs import (
    EmptyBronze,
    JobConfig,
    RejectedReadings,
    run_all,
    run_event_geo,
    run_sensor_health,
    run_temp_humidity,
)

__all__ = ["EmptyBronze", "JobConfig", "RejectedReadings", "run_all", "run_event_geo", "run_sensor_health", "run_temp_humidity"]
