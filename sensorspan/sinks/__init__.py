"""Writers: JSON, CSV and Parquet exports, data layout."""
