"""Composite pipelines, role views over the test tables, registered queries."""
