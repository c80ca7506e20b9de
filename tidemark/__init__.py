"""Spark-native cleaning and analytics of semi-structured records."""
