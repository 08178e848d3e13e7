"""Composed jobs: seeds, incremental load, reports and quality checks."""
