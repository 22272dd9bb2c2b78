"""Composite jobs, their inputs and their sinks."""
