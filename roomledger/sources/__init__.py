"""Sources and sinks: the driver-table adapter, CSV in/out, versioned parquet tables."""
