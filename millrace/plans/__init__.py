"""Logical plans built from the operators: models, ingest and contract queries."""
