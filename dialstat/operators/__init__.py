"""Relational operators of the campaign pipeline."""
