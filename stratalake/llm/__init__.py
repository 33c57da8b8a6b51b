"""Operators for preparing language-model training data.

Each module holds one operator behind a general interface; ``queries`` applies
every operator to its whole table. Nothing outside this package imports it.
"""
