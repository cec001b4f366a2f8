"""Spark-native preparation and evaluation of instruction-tuning data."""
