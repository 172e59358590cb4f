"""Spark-native ingestion and labelling of scholarly article records."""
