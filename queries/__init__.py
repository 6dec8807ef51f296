"""Registered queries: each operator over tables derived from the given data."""
