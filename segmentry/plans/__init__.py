"""The named pipelines."""
