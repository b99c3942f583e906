"""Every registered query of this folder, next to its SQL where it has one; and the pipeline."""

import pathlib

import duckdb
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from lavra.llm.queries import QUERIES
from lavra.session import staged
from tests.llm.test_decontaminate import plain as leaks
from tests.llm.test_quality import plain as metrics
from tests.llm.test_simhash import classes, plain_fingerprint
from tools.check_sql import table

FOLDER = pathlib.Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not FOLDER.is_dir(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = entry_points.queries()[name](spark, str(FOLDER))
    source = {"op5": "pages", "op13": "embeddings"}.get(name.split("_")[0], "documents")
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == db.execute(f"select count(*) from {source}").fetchone()[0]
    if name in entry_points.oracle_sql():
        result = db.execute(entry_points.oracle_sql()[name])
        assert table(df.columns, rows) == table([d[0] for d in result.description], result.fetchall())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    after = docs
    for name, stage in corpus_pipeline.STAGES:
        before, after = after.collect(), staged(stage(spark, after, str(FOLDER)), name)
        rows = after.collect()
        if name == "quality_rules":
            # So few labels certify nothing: only the base rules act.
            assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in before if not metrics(r.text)[-1])
        if name == "near_dedup":
            prints = {r.doc_id: plain_fingerprint(r.text) for r in before}
            near = [(a, b) for a in prints for b in prints if (prints[a] ^ prints[b]).bit_count() <= 3]
            assert sorted(r.doc_id for r in rows) == sorted(set(classes(near, prints).values()))
        if name == "decontamination":
            clean = [r.doc_id for r, (_, hit, _) in zip(before, leaks([(r.doc_id, r.text) for r in before], items)) if not hit]
            assert sorted(r.doc_id for r in rows) == sorted(clean)
        if name == "mix":
            assert {r.doc_id for r in rows} <= {r.doc_id for r in before} and len(rows) > len(before)
        if name == "shards":
            assert len(rows) == len(before) and {r.shard for r in rows} <= set(range(24))
        else:
            assert after.columns == docs.columns
    again = corpus_pipeline.run(spark, str(FOLDER))
    assert sorted(map(str, again.collect())) == sorted(map(str, rows))
