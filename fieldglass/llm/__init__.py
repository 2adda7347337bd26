"""Operators for building training data for language models, with their queries and SQL."""
