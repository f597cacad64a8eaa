"""Raw schemas, CSV input, Parquet tables and CSV export."""
