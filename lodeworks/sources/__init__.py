"""Readers and writers. Only this package, ``streaming`` and ``jobs`` run actions."""
