"""Operators for preparing text corpora, as Spark jobs."""
