"""Readers that return typed DataFrames."""
