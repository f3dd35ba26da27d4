"""Scans and sinks: parquet tables, fixture adapters, catalog, GeoJSON, CSV."""
