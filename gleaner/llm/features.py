"""Word features as DataFrame expressions: no Python runs on the executors.

Words are ``[^\x20\x09-\x0D]+``.  Nothing here shuffles; every function maps a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
_SPLIT = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Array of the words; empty for null, empty or white text."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, _SPLIT))


def constant(values: np.ndarray, kind: str) -> Column:
    """A constant array, folded into the plan once (sizes are bounded by the callers)."""
    text = ",".join(f"{v:.6g}" if kind == "float" else str(int(v)) for v in values)
    return F.split(F.lit(text), ",").cast(f"array<{kind}>")


def one_row(spark: SparkSession, values: pa.Array) -> Column:
    """An array as a scalar subquery over a table of one row: it stands in no plan, and lookups do not copy it.

    Select it as a column and refer to that column once, from the next select:
    the planner then moves the subquery to where it is used.
    """
    row = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    return spark.createDataFrame(pa.table({"entries": row})).scalar()


def bounded_sample(rows: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows at the most, chosen by a hash of doc_id; all while there are fewer."""
    n = rows.count()
    return rows if n <= most else rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * most / n))
