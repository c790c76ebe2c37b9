"""Operators for large text corpora, built on DataFrames; nothing else in the library imports this package."""
