"""Operators of a training-data pipeline: dedup, filters, packing, formatting and scoring.

Nothing outside this folder imports it. :mod:`tidemark.llm.registry` names
the queries over the driver tables and their SQL.
"""
