"""Reusable DataFrame operators: upserts, scans, interval and spatial joins, cell grids."""
