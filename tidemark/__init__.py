"""Snapshot-history, data-quality and text-corpus analytics on Spark DataFrames."""
