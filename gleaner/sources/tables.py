"""Driver tables: one parquet file per table under an sf directory.

Readers return plain DataFrames; column pruning and filter pushdown happen
in Catalyst when the caller selects/filters, so nothing is projected here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


#: Largest table (planner's size estimate) that ``spread`` deals out anew.
SPREAD_BYTES = 64 << 20
#: Bytes of files that one micro-batch of a streamed table takes in (one larger file: all of it).
BATCH_BYTES = 256 << 20


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, one file or a folder of files, read as a file stream (schema from the batch reader).

    The path is a pattern that only the table fits: a stream takes a plain path for a folder.
    """
    schema = read_table(spark, sf_dir, name).schema
    return (spark.readStream.schema(schema).option("maxBytesPerTrigger", BATCH_BYTES)
            .parquet(table_path(sf_dir, f"[{name[0]}]{name[1:]}")))


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy row-local work at least one task per core.

    A small table stored as one file with one row group scans as a single task;
    it is round-robin repartitioned to the default parallelism (filters and
    column pruning still reach the scan below the repartition).  Tables above
    ``SPREAD_BYTES`` are left alone: they are never shuffled for this.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size <= SPREAD_BYTES and df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df
