"""Operators of a training-data pipeline (one module per operator).

Nothing else in the library imports this subpackage. The driver-facing
queries are in ``queries.py``.
"""
