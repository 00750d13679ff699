"""Operators of a training-data pipeline: extraction, language, scoring, deduplication, packing.

Nothing outside this subpackage imports it. Every operator takes and returns
DataFrames; Python runs only inside tasks, on Arrow batches that Spark deals out.
"""
