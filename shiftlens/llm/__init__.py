"""Operators of a training-data pipeline, each with one registered query.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries only when it can be imported.
"""
