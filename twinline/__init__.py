"""twinline: a Spark-native engine for curating two-speaker speech corpora."""
