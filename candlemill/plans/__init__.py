"""Load pipelines."""
