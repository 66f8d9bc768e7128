"""Dispute-risk analytics on Spark: event log to features, mined rules, scored models."""

__version__ = "0.1.0"
