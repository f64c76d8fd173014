"""Spark-native inventory, rule and corpus analytics."""
