"""Operators for preparing training corpora: ten methods, their queries and their SQL.

Nothing outside this package imports it, apart from the guarded registration in ``__spark_entry__.py``.
"""
