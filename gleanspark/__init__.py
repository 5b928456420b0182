"""Captured listing and detail pages to clean posting tables, on Spark."""
