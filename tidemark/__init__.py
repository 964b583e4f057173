"""A Spark-native engine for market time series and training-data pipelines."""
