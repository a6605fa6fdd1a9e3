"""Sources and sinks: CSV / Parquet files, JDBC, the source catalogue and ingest manifest."""
