"""Spark-native analytics for multi-country banking, insurance and mobile-money data."""
