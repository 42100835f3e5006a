"""fleetmeter: GPU-fleet telemetry analytics as plain PySpark DataFrame functions."""

__version__ = "0.1.0"
