"""A Spark-native engine for EVM block analytics."""
