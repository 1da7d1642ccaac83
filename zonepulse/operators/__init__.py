"""DataFrame -> DataFrame operators: ingest, zone-day metrics, grid, summary."""
