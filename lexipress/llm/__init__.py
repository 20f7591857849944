"""Operators for large-scale training-data pipelines.

Nothing outside this subpackage imports it; the queries that apply the
operators to whole tables are in :mod:`lexipress.llm.queries`.
"""
