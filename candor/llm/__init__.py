"""Operators of a training-data pipeline over document, page and conversation tables.

Nothing else in the package imports this subpackage; ``llm.queries`` registers its queries.
"""
