"""Operators for preparing training text.

Nothing outside this subpackage imports it. Each module holds one operator as functions over DataFrames; ``queries`` holds the
registered queries that apply them to the driver's tables.
"""
