"""JSON collections as input, catalog tables as storage."""
