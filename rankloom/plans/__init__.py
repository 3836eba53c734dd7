"""Composed flows: scoring, top-N, metrics, ALS training and tuning."""
