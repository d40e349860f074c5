"""Whole-table transforms composed from the operators."""
