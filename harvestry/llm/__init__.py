"""Operators for building language-model training data, as Spark jobs."""
