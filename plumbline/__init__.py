"""Data-quality and governance analytics as Spark jobs.

Every operator takes DataFrames plus explicit parameters and returns a lazy
DataFrame built from Spark's own functions.
"""
