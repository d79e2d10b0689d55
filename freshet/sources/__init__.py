"""Readers: landed files (JSON, CSV, GeoJSON, HTML) to typed rows."""
