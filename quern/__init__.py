"""A Spark-native engine for curating, validating and reshaping document corpora."""
