"""gleaner: turn captured web pages, XML records and listings into tables on Spark.

Every public operator is either ``Column -> Column`` (``gleaner.functions``)
or ``DataFrame -> DataFrame`` (``gleaner.operators``).  Sources build
capture tables from parquet or files (``gleaner.sources``); named plans over
the driver tables live in ``gleaner.plans``; incremental forms in
``gleaner.streaming``.
"""

__all__ = ["session"]
