"""Composite pipelines (cleansed store, compat readers), the test-table
mapping, the query registry and its SQL oracle."""
