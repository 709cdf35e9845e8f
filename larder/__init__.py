"""Spark-native replenishment analytics for perishable goods."""
