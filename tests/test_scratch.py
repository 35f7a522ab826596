import time
from types import SimpleNamespace

import pytest
from hypothesis import given
from hypothesis import strategies as st

from loanlens import scratch
from loanlens.catalog import tables
from loanlens.llm.store import Store
from loanlens.operators.cleanse import standard_name


def session(master, named=None, set_before=None):
    calls = []
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: calls[-1] if calls else set_before,
        setCheckpointDir=calls.append,
        applicationId="app",
    )
    conf = SimpleNamespace(get=lambda key, default: named)
    return SimpleNamespace(conf=conf, sparkContext=context), calls


def test_named_folder_is_used():
    spark, calls = session("yarn", named="hdfs://shared/cp")
    assert scratch.shared_folder(spark) == "hdfs://shared/cp" and calls == ["hdfs://shared/cp"]
    assert scratch.new_folder(spark, "gold").startswith("hdfs://shared/cp/app/gold-")


@pytest.mark.parametrize("master", ["spark://host:7077", "local-cluster[2,1,1024]", "yarn"])
def test_cluster_without_a_shared_folder_is_an_error(master):
    spark, _ = session(master)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(spark)


def test_local_session_gets_a_folder():
    spark, calls = session("local[2]")
    assert scratch.shared_folder(spark) == calls[0]


def test_temporary_folder_goes_even_after_an_error(spark):
    with pytest.raises(ValueError), scratch.temporary(spark, "raw") as path:
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
        raise ValueError
    with pytest.raises(Exception):
        spark.read.parquet(path)


@given(st.text())
def test_standard_names_are_stable(text):
    name = standard_name(text)
    assert standard_name(name) == name
    assert set(name) <= set("abcdefghijklmnopqrstuvwxyz0123456789_")
    assert not name.startswith("_") and not name.endswith("_") and "__" not in name


def test_shuffle_files_of_a_stored_table_go(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: str(files.getAllFiles().mkString(" ")).count("shuffle_")
    before = spark.conf.get(scratch._SHUFFLE_CLEANUP, None)
    Store(spark).put("dealt", spark.range(1000).repartition(3, "id"))
    start = shuffled()
    for _ in range(3):
        Store(spark).put("dealt", spark.range(1000).repartition(3, "id"))
    for _ in range(50):  # files go beside the driver's work
        if shuffled() <= start:
            break
        time.sleep(0.1)
    assert shuffled() <= start
    assert spark.conf.get(scratch._SHUFFLE_CLEANUP, None) == before


def test_derived_tables_are_built_tidily(spark):
    seen = []
    tables.stored(spark, "nowhere", "probe", lambda _: seen.append(spark.conf.get(scratch._SHUFFLE_CLEANUP)))
    assert seen == ["true"]
