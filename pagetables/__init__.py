"""Typed datasets from captured web pages, on Spark."""
