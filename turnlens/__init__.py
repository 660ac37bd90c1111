"""Spark-native profiling, preparation and curation of multi-turn conversation corpora."""
