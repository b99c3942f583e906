import random
import zlib

from lavra.llm import sharding
from tests.llm.data import SCHEMA, clashing, odd_rows, prose


def make(spark, n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        t = prose(rng, rng.randrange(1, 60))
        rows.append((i, t, rng.choice(["en", "de", None]), "hot" if i % 3 else f"s{i % 11}", len(t)))
    return rows


def test_shards_are_near_equal_and_gapless(spark):
    rows = make(spark, 3000)
    docs = spark.createDataFrame(rows, SCHEMA)
    found = sharding.numbered(docs, ["doc_id"], leaves=24).collect()
    text = {r[0]: r[1] for r in rows}
    by_shard = {}
    for r in found:
        assert r.size == len(text[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
        by_shard.setdefault(r.shard, []).append(r)
    assert sorted(by_shard) == list(range(24)) and len(found) == 3000
    sizes = [sum(r.size for r in rs) for rs in by_shard.values()]
    biggest = max(r.size for r in found)
    assert max(sizes) - min(sizes) <= 3 * biggest
    assert all(sorted(r.slot for r in rs) == list(range(len(rs))) for rs in by_shard.values())
    again = {r.doc_id: (r.shard, r.slot) for r in sharding.numbered(docs.repartition(9), ["doc_id"], leaves=24).collect()}
    assert again == {r.doc_id: (r.shard, r.slot) for r in found}
    assigned = {r.doc_id: r.shard for r in sharding.assign_shards(docs).collect()}
    assert assigned == {r.doc_id: r.shard for r in found}


def test_leaves_by_bytes_and_one_hot_value(spark):
    rows = [(i, "x" * 92, "en", "one", 92) for i in range(400)]
    found = sharding.assign_shards(spark.createDataFrame(rows, SCHEMA), leaves=None, target_bytes=10_000)
    counts = [r["count"] for r in found.groupBy("shard").count().collect()]
    assert len(counts) == 4 and max(counts) - min(counts) <= 2


def test_odd_rows(spark):
    rows = odd_rows()
    docs = clashing(spark.createDataFrame(rows, SCHEMA))
    found = sharding.assign_shards(docs, leaves=5)
    assert found.columns == [c for c in docs.columns if c != "shard"] + ["shard"]
    assert found.where("shard is null").count() == 0 and found.count() == len(rows)
    got = sharding.numbered(docs, ["doc_id"], leaves=5)
    assert sorted(r.size for r in got.collect()) == sorted(len((r[1] or "").encode()) + 8 for r in rows)
    assert sharding.assign_shards(spark.createDataFrame([], SCHEMA)).count() == 0
    few = sharding.assign_shards(spark.createDataFrame(rows[:2], SCHEMA), leaves=24).collect()
    assert len({r.shard for r in few}) == 2
    assert sharding.assign_shards(docs.select("doc_id", "text"), leaves=3).select("shard").distinct().count() == 3


def test_copies_of_a_text_are_numbered_in_many_runs(spark):
    rows = [(i, "one text for all of them", "en", "s", 24) for i in range(6000)]
    found = sharding.numbered(spark.createDataFrame(rows, SCHEMA), ["doc_id"], leaves=4)
    slots = {}
    for r in found.collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
