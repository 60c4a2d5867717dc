"""Sources and sinks: landed CSV staging, the driver-table adapter, parquet vault storage."""
