"""Sources: text line scans, parquet tables and the test-table views."""
