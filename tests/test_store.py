"""The shared folder: whose it is, when there is none, and what is removed from it."""

import os
from types import SimpleNamespace

import pytest

from scriptorium import store


def session(master, setting=None, given=None):
    get = lambda key, default=None: setting
    context = SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=get), getCheckpointDir=lambda: given)
    return SimpleNamespace(conf=SimpleNamespace(get=get), sparkContext=context)


def test_shared_root():
    assert store.shared_root(session("yarn", "hdfs://n/x/")) == "hdfs://n/x"
    assert store.shared_root(session("yarn", None, "hdfs://n/given")) == "hdfs://n/given"
    assert store.shared_root(session("local[4]")).startswith("file:///")
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://host"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            store.shared_root(session(master))


def test_stored_tables_are_removed(spark):
    path = lambda df: df.stored_at.removeprefix("file://")
    first = store.materialise(spark.range(3), "t")
    with store.scratch() as keep:
        second, third = store.materialise(spark.range(4), "t"), keep(store.materialise(spark.range(5), "t"))
        assert second.count() == 4
    assert [os.path.isdir(path(x)) for x in (first, second, third)] == [True, False, True] and third.count() == 5
    store.discard(first, third, spark.range(1))
    assert not os.path.isdir(path(first)) and not os.path.isdir(path(third))


def test_small_tables_are_dealt_out(spark):
    small = store.spread(spark.range(10, numPartitions=1))
    assert small.count() == 10 and "Exchange RoundRobinPartitioning" in small._jdf.queryExecution().toString()


def test_fresh_names():
    assert store.fresh(["a", "B_"], "b") == "b" and store.fresh(["A", "a_"], "a") == "a__"
