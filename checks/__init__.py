"""Checks of the library on the given tables: inputs, queries, expected results."""
