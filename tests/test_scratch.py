"""Tables written during a job, and what they leave on the disk."""

import os
import time

import pytest

from ovenplan import session


def shuffle_files(spark) -> set[str]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {name for d in folders for _, _, files in os.walk(d.getPath()) for name in files if name.startswith("shuffle_")}


def test_shuffle_files_go_after_the_write(spark):
    before = shuffle_files(spark)
    grouped = spark.range(10_000).selectExpr("id % 100 as k").groupBy("k").count()
    table = session.materialize(grouped, "scratch-test")
    until = time.time() + 20  # executors delete in the background
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert table.count() == 100 and table.columns == grouped.columns
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == "false"
    # The frame itself can still be run again.
    assert grouped.count() == 100


def test_setting_of_the_session_is_kept(spark):
    spark.conf.set(session.SHUFFLE_CLEANUP, "true")
    try:
        session.materialize(spark.range(10), "scratch-test")
        assert spark.conf.get(session.SHUFFLE_CLEANUP) == "true"
    finally:
        spark.conf.unset(session.SHUFFLE_CLEANUP)


def test_scratch_tables_end(spark):
    scratch = session.Scratch(spark, "scratch-test")
    first = scratch.write(spark.range(10), "first")
    second = scratch.write(first.selectExpr("id + 1 as id"), "second")
    scratch.drop("first")
    assert os.listdir(scratch.root.removeprefix("file:")) == ["second"]
    assert sorted(r.id for r in second.collect()) == list(range(1, 11))
    with pytest.raises(ValueError):
        session.remove(spark, "/elsewhere/table")
