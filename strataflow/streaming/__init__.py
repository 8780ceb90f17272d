"""Event streams: watermarks, deduplication, late rows."""
