"""Scans and generators."""
