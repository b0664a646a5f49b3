"""A Spark-native engine for evidence reconciliation, web-page analytics and training-data pipelines."""
