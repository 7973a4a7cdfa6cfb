"""haven — Spark-native analytics for homelessness-response (HMIS) data."""

__version__ = "0.1.0"
