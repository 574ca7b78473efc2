"""Layered batch analytics on Spark DataFrames.

Landing batches become bronze tables with lineage, silver tables with typed,
checked and current rows, a core model of dimensions and facts, a Type 2
history dimension, and aggregate marts.  Every step is a function from
DataFrames to DataFrames; the caller owns the session and its settings.
"""
