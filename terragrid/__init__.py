"""A PySpark-native engine for gridding land-surface data."""
