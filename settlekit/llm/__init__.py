"""Training-data operators: one module per operator, ``queries.py`` registers them.

Nothing else in the library imports this package.
"""
