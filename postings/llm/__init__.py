"""Operators of a training-data pipeline on Spark: duplicates, contamination, toxicity, language models, shards."""
