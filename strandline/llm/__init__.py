"""Operators of a training-data pipeline over documents, pages and benchmark texts.

Every operator takes and returns DataFrames, picks the columns it needs by name
(further columns never clash) and states in its docstring what it does with
nulls, empty texts, repeated rows and empty tables.  ``queries`` registers one
query for each of them.
"""
