"""Wiring of operators to the shared test tables (queries) and their SQL twins (oracle)."""
