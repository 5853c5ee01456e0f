"""Operators of a training-data pipeline: scoring, dedup, mixing, packing, output."""
