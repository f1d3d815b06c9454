"""Operators of a training-data pipeline: deduplication, archives, quality, PII, packing, tokens.

Nothing else in the library imports this subpackage.  The registered queries
and their SQL are in :mod:`blotter.llm.queries`.
"""
