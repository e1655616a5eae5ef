"""Readers and writers: KML, GeoJSON, metadata, tides, surveys, wide tables, settings."""
