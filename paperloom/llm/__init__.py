"""Operators for preparing large text corpora.

Each module holds one operator with a general interface over DataFrames.
``registry`` holds the thin queries over the standard tables and their SQL.
Nothing outside this subpackage imports it.
"""
