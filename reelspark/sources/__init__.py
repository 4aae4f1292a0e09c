"""Sources and sinks: raw CSV files, tables (Parquet, JDBC, any DataFrame
format) and the mapping of the shared test tables onto the rating model."""
