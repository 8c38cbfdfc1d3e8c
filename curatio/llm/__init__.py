"""Operators of a training-data pipeline; nothing outside this package imports it.

Every operator takes and returns DataFrames.  Row-wise operators (quality,
decontamination, language, toxicity) append one struct column, whose name is
a parameter; an input column of that name is replaced, every other column
passes through untouched, so extra columns never clash.  Grouping operators
return new frames with the columns their docstrings list.
"""
