"""Catalog work and the jobs that write tables."""
