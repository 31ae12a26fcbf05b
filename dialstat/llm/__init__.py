"""Operators of a training-data pipeline: filters, deduplication, decontamination, scoring, mixing."""
