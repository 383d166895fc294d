"""tideline: a Spark-native analytics engine for high-frequency event streams."""
