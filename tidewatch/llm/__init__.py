"""Operators for preparing large text corpora, each a set of Spark jobs."""
