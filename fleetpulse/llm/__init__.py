"""Operators of a training-data pipeline: search, cleaning, scoring, packing."""
