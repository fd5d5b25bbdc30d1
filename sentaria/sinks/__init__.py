"""Parquet (and optional JDBC) writers."""
