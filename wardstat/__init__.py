"""Facility staffing and quality analytics as plain Spark DataFrame functions."""
