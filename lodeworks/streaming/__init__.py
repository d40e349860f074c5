"""Loads that pick up where the last one stopped."""
