"""Rental analytics on Spark DataFrames: quality, incremental state, star schema, marts."""
