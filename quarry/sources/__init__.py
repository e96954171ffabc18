"""Readers, writers and the test-table loader."""

from .tables import Tables, load_table  # noqa: F401
