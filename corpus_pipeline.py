"""From raw documents to token shards, in five stages.

1. quality rules: documents that the rules reject go;
2. near-duplicates: one document of each group stays;
3. benchmark decontamination: documents that hold a benchmark item go;
4. mixing: documents stay as often as their fitted rates say;
5. token ids: the rest is encoded into indexed shards.

Each stage reads only what its predecessor kept (written as Parquet between
them); stages 1 to 4 return the columns of ``documents``, the last one a row per
stored document, read back through the index.  What a stage wrote on its way to a
result goes when the next one is called, as that reads the written result.

Defined cases: a null, empty or white text fails the quality rules.  Rows that share a
doc_id are judged each on its own by stages 1, 3 and 4; near-duplicates keep one of
them, and rows without a doc_id all stay.  Repeated rows that come through are mixed
and stored as often as they stand there.  An empty table gives an empty result.
Extra columns are carried through stages 1 to 4 and read by none.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from gleaner.llm import decontaminate, mixing, near_dedup, quality, token_store
from gleaner.llm.common import discard, recorded, stored, table
from gleaner.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Per application the scratch tables of the stage called last.
_SCRATCH: dict[str, list[str]] = {}


def stage(function: Stage) -> Stage:
    """Once the next stage is called, the result of the one before it is written: its scratch tables go."""
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, _SCRATCH.pop(spark.sparkContext.applicationId, []))
        with recorded() as made:
            out = function(spark, docs, sf_dir)
        _SCRATCH[spark.sparkContext.applicationId] = made
        return out
    return run_stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    weights = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.kept_rows(docs, weights)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs, shingle=5, per_cent=80).select(*docs.columns)


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@stage
def target_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.resample(docs, table(spark, sf_dir, "labels")).select(*docs.columns)


@stage
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_store.round_trip(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", target_mixing),
    ("token ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stored(function(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs


#: The stages' rules (sketches, fitted rates, tokenizer) are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
