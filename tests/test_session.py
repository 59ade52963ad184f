"""Checkpoint folder and scan spreading."""

import os

from gleaner.session import SHUFFLE_CLEANUP_CONF, checkpoint_root, materialize
from gleaner.sources.tables import read_table, spread


def test_checkpoint_root_is_the_session_setting(spark):
    root = checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")


def test_materialize_writes_under_checkpoint_dir(spark):
    df = materialize(spark.range(10))
    assert df.count() == 10
    root = spark.conf.get("spark.checkpoint.dir").replace("file:", "")
    assert any(os.scandir(root))


def test_spread_only_single_split_scans(spark, sf_small):
    pages = read_table(spark, sf_small, "pages")
    assert pages.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism
    assert spread(pages).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 1000, numPartitions=spark.sparkContext.defaultParallelism * 2)
    assert spread(many).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism * 2


def test_what_materialize_shuffled_goes_with_the_write(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    count = lambda: sum(x.startswith("shuffle_") for d in dirs for _, _, names in os.walk(d) for x in names)
    before, setting = count(), spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    df = materialize(spark.range(2000).selectExpr("id % 700 AS k").groupBy("k").count())
    assert count() <= before and df.count() == 700
    assert spark.conf.get(SHUFFLE_CLEANUP_CONF, None) == setting
