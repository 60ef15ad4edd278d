"""Vital-sign and patient analytics as DataFrame-to-DataFrame Spark operators."""
