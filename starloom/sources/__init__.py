"""Storage-facing helpers: raw paths, catalog tables, metadata-driven ingest."""
