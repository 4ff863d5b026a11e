"""Sources and sinks: landed payloads, driver-table shaping, Parquet warehouse, exports."""
