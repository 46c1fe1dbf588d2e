"""Operators on text corpora for language-model training data. Nothing else in the library imports this package."""
