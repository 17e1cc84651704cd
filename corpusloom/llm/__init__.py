"""Operators for large training-data pipelines.

Nothing outside this subpackage imports it.  Every operator lives in a module
of its own; ``registry`` holds the thin ``opN_<name>`` queries and their SQL.
"""
