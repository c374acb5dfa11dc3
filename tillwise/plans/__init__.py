"""Whole plans: the layered model, the batch pipeline and the serving queries."""
