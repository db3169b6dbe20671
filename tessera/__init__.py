"""Tessera: Spark-native scoring, comparison and auditing of predictions against truth tables."""
