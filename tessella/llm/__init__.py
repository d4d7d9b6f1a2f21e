"""Operators of a training-data pipeline: search, language, tokens, lists, near copies, quality,
packing and archives. Nothing else in the library imports this package."""
