"""Batch operators: pure ``DataFrame -> DataFrame`` functions."""
