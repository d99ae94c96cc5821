"""Readers: CSV, Parquet, tables, message topics, API payloads and rides."""
