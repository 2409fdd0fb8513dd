"""Operators of a training-data pipeline.

Every operator takes DataFrames with declared columns and leaves other columns alone. Nothing else in the library
imports this package.
"""
