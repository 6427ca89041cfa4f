"""Operators of a training-data pipeline: cleaning, de-duplication, scoring and tokens."""
