"""Operators of a training-data pipeline over documents, pages and labels.

Nothing outside this package imports it; its queries register through
``citylens.llm.queries`` and, guarded, through the driver's entry module.
"""
