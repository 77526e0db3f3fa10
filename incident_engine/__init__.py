"""Spark-native analytics for timestamped, geolocated incident records."""
