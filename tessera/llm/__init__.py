"""Operators of a training-data pipeline over text, page and vector tables.

Nothing outside this subpackage imports it.  ``queries.py`` holds the thin
registered queries (``opN_<name>``) that apply an operator with production
parameters to its whole table.
"""
