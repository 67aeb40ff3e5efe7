"""Spark-native ingestion and merge of recurring tabular feeds."""
