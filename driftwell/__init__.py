"""Adaptive ingestion and querying of semi-structured change events on Spark.

Every operator takes DataFrames and returns DataFrames; nothing is collected to
the driver except metadata whose size has been checked.
"""
