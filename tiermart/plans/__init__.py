"""The pipelines, composed from sources, operators and functions."""
