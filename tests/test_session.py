from types import SimpleNamespace

import pytest

from daybook.session import saved_table, shared_folder


def session(folder, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: folder or default),
        sparkContext=SimpleNamespace(master=master, applicationId="app"),
    )


def test_the_named_folder_is_used():
    first = shared_folder(session("s3://bucket/work/", "spark://host"), "cuts")
    second = shared_folder(session("s3://bucket/work/", "spark://host"), "cuts")
    assert first.startswith("s3://bucket/work/cuts-") and first != second


def test_a_cluster_needs_a_named_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session(None, "spark://host"), "cuts")
    assert "daybook-" in shared_folder(session(None, "local[2]"), "cuts")


def test_saved_table(spark):
    made = spark.createDataFrame([(1, "a"), (2, None)], "n int, t string")
    back = saved_table(made, "test")
    assert back.schema == made.schema
    assert sorted(map(tuple, back.collect())) == [(1, "a"), (2, None)]
    assert saved_table(made.limit(0), "test").collect() == []
