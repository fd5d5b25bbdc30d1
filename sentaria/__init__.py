"""Multilingual sentence-corpus analytics expressed as Spark DataFrames."""
