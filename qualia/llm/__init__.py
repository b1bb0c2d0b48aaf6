"""Operators of a training-data pipeline: filters, deduplication, tokenization, packing and output.

Nothing else in the library imports this subpackage; ``queries.py`` registers one query per operator.
"""
