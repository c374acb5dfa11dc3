"""Operators of training-data pipelines for language models."""
