"""Registers as Parquet directories: finding, reading, describing, writing."""
