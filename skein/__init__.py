"""skein: a PySpark-native engine for case-partitioned network data."""
