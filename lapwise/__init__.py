"""Layered analytics over season-partitioned archives, on Spark DataFrames.

Files are landed as text with lineage, typed and upserted by change hash,
projected into a star, and read through views.  Every step is a function from
DataFrames to DataFrames; nothing here runs rows through Python.
"""
