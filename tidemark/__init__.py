"""Spark-native retrieval, evaluation and telemetry analytics."""
