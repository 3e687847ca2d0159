from __future__ import annotations

from types import SimpleNamespace

import pytest

from tidemark.plans.model import RUNS
from tidemark.session import inline, shared_folder, side_by_side


def session(**settings):
    """Only the settings of a session; the folder depends on nothing else."""
    known = {key.replace("__", "."): value for key, value in settings.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: known.get(key, default)))


def test_scratch_lies_in_the_folder_the_cluster_names():
    cluster = session(spark__master="spark://host:7077", spark__checkpoint__dir="hdfs:///shared/")
    first, second = shared_folder(cluster, "drops"), shared_folder(cluster, "drops")
    assert first.startswith("hdfs:///shared/drops-") and first != second


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session(spark__master="yarn"), "drops")


def test_a_local_master_may_use_its_own_disk():
    local = session(spark__master="local[4]")
    folders = {shared_folder(local, "a").rsplit("/", 1)[0], shared_folder(local, "b").rsplit("/", 1)[0]}
    assert len(folders) == 1


def test_the_session_setting_is_read(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark, "x")
    assert folder.startswith(named) if named else "tidemark-" in folder


def test_inline_rows_know_their_types(spark):
    empty = inline(spark, (), RUNS)
    assert empty.count() == 0 and [f.dataType for f in empty.schema] == [f.dataType for f in RUNS]


def test_jobs_side_by_side_keep_order_and_raise():
    assert side_by_side([lambda n=n: n * n for n in range(6)]) == [0, 1, 4, 9, 16, 25]
    with pytest.raises(ZeroDivisionError):
        side_by_side([lambda: 1, lambda: 1 // 0])
