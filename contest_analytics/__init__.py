"""Spark-native analytics over contest records: trends, win rates, feature tables, models."""
