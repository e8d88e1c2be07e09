"""Operators of a training-data pipeline: dedup, filtering, decontamination, scoring and packing."""
