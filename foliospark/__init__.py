"""Spark-native analytics over scanned, list-like documents."""
