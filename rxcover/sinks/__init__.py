"""Writers: Parquet, CSV, catalog tables and report data sets."""
