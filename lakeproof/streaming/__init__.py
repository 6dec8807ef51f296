"""Continuous form of the inventory step."""
