"""Training-data operators: filters, classifiers, dedup, similarity joins, token counts and mixing.

Nothing else in the library imports this package; `queries.py` registers it.
"""
