"""Operators for training-data pipelines: text, vectors, pages and conversations.

Nothing outside this subpackage imports it. ``queries.py`` registers one query per
operator, ``oracle.py`` holds the DuckDB SQL of those that SQL can express.
"""
