"""Writers: replay-safe parquet tables and relational tables."""
