"""Operators that prepare training text and vectors, and the queries that apply them.

Nothing else in the library imports this package. Every operator takes DataFrames and
column names, keeps whole texts and whole tables, and leaves its state either in the
plan or in Parquet below the shared checkpoint folder.
"""
