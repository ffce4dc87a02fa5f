"""Operators for large training-text corpora, and the queries that apply them to the whole tables."""
