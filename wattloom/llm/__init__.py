"""Operators that prepare training data for language models, on DataFrames of documents or pages."""
