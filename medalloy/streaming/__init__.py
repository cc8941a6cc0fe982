"""Incremental (file-arrival) form of the Bronze loaders."""
