"""Operators of a training-data pipeline over documents, pages and conversations.

Nothing else in the library imports this package; ``__spark_entry__.py`` adds its
queries only where it is present.
"""
