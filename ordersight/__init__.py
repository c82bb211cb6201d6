"""Retail order analytics as lazy PySpark DataFrame functions."""
