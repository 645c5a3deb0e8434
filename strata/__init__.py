"""Metadata-driven landing -> bronze -> silver -> gold processing on plain PySpark."""
