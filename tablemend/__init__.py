"""Reconciliation, change loading and repair of warehouse tables with PySpark.

Every operator takes DataFrames plus declared key and time columns and returns
a DataFrame (or a Column); only sinks and streaming jobs start work.
"""
