"""sensorspan: Spark-native analytics for environmental sensor telemetry."""

__version__ = "0.1.0"
