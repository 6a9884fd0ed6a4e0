"""Whole pipelines over a table store, and the registry of checkable queries."""
