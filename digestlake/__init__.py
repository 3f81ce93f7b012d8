"""digestlake: a PySpark-native engine for post digests and training-data pipelines."""
