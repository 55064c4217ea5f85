"""Operators of training-data pipelines: quality, dedup, decontamination, formatting, mixing."""
