"""Operators of a training-data pipeline: one module per operator.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds its
queries when it can be imported.
"""
