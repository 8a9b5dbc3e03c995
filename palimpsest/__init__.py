"""Spark-native pseudonymisation, profiling and verification engine."""
