"""Writers: Parquet layouts, exports, warehouse tables and message topics."""
