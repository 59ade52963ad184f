"""Operators for building large training corpora, on top of Spark.

Nothing else in the library imports this package; ``__spark_entry__`` adds
its queries when it is present.
"""
