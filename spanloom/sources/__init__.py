"""Scans and their partitioning."""
