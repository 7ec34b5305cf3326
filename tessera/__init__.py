"""Spark-native record linkage and analytics."""
