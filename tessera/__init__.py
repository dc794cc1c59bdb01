"""Spark-native label-corpus analytics."""
