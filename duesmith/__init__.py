"""Receivables and billing-integrity operators for PySpark."""

__version__ = "0.1.0"
