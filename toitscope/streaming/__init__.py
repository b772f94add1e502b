"""Incremental loading of landed files."""
