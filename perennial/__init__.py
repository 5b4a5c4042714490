"""Spark-native data engine for continually retrained classifiers."""
