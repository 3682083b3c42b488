"""Clickstream and ad-click analytics as plain Spark DataFrame functions."""
