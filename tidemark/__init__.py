"""Governed analytics on Spark: DataFrame operators, loads, quality, catalog and streaming jobs."""
