from types import SimpleNamespace

import pytest

from lavra.session import hot_limit, shared_folder, staged


def fake(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_shared_folder():
    assert shared_folder(fake("yarn", "hdfs://x/y/")) == "hdfs://x/y"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(fake("yarn"))
    local = fake("local[2]")
    assert shared_folder(local) == shared_folder(local)


def test_staged_keeps_schema_and_rows(spark):
    df = spark.range(5).selectExpr("id", "cast(null as string) as s", "array(id) as a")
    copy = staged(df)
    assert copy.schema.simpleString() == df.schema.simpleString()
    assert sorted(copy.collect()) == sorted(df.collect())
    assert shared_folder(spark) in copy.inputFiles()[0]


def test_hot_limit():
    assert hot_limit(10, 4, floor=5) == 5
    assert hot_limit(1000, 4, floor=5) == 250
