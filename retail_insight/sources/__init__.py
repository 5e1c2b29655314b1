"""Sources: catalog / parquet tables, the driver-table mapping, the ad log."""
