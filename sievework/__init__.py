"""Spark-native curation of tool-conversation datasets and training corpora."""
