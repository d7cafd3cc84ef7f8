"""A Spark-native engine for quad data: pattern matching, patches, keyword search and streaming ingest."""
