"""Spark-native analytics over large, ordered transcript corpora."""
