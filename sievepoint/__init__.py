"""Screening of form submissions on Spark: features, rules, encoders, splits, models, reports."""

__version__ = "0.1.0"
