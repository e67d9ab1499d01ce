"""Operators that prepare text for training language models.

Every operator takes DataFrames and returns a DataFrame. Columns are named by
parameters; only those are read, so further columns of the input, whatever their
names, change nothing.
"""
