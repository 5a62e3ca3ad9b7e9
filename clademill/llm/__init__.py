"""Training-data operators: one module each, queries in ``queries.py``.

Nothing outside this folder imports it.
"""
