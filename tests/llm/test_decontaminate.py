import random
import re

import pytest

from lavra.llm import decontaminate
from tests.llm.data import SCHEMA, clashing, odd_rows, prose

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(rows, items, size=10):
    out = []
    for r in rows:
        w = words(r[1])
        hit, found = set(), set()
        for name, text in items:
            x = words(text)
            n = min(size, len(x))
            for i in range(len(x) - n + 1) if n and name is not None else ():
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == x[i : i + n]:
                        hit |= set(range(j, j + n))
                        found.add(str(name))
        out.append((len(w), sorted(hit), sorted(found)))
    return out


def make():
    rng = random.Random(4)
    items = [(i, prose(rng, rng.choice([3, 9, 14, 25]))) for i in range(12)]
    items += [(12, None), (13, ""), (14, "one"), (15, items[2][1]), (3, items[3][1]), (None, "never named item"), (16, "É ß Ünï")]
    rows = odd_rows()
    for i in range(25):
        inner = rng.choice(items)[1] or ""
        cut = inner.split(" ")[rng.randrange(3) :]
        rows.append((100 + i, f"{prose(rng, 20)} {'. '.join(cut).upper()}; {prose(rng, 20)} One", "en", "s", 1))
    rows.append((200, "one ONE é ß ünï É ß ünï", "fr", "s", 1))
    return rows, items


@pytest.mark.parametrize("table_bytes", [decontaminate.TABLE_BYTES, 0])
def test_scan(spark, table_bytes):
    rows, items = make()
    docs = clashing(spark.createDataFrame(rows, SCHEMA))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.scan(docs, benchmark, table_bytes=table_bytes)
    assert set(docs.columns) - set(found.columns) <= {"_row"}
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, sorted(r.hit_places), list(r["items"]), r.contaminated) for r in found.collect())
    assert got == sorted((str(r[0]), n, len(h), h, f, bool(h)) for r, (n, h, f) in zip(rows, plain(rows, items)))


def test_removal(spark):
    rows, items = make()
    docs = clashing(spark.createDataFrame(rows, SCHEMA))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = decontaminate.decontaminate(docs, benchmark)
    assert whole.columns == docs.columns
    clean = [str(r[1]) for r, (_, h, _) in zip(rows, plain(rows, items)) if not h]
    assert sorted(str(r.text) for r in whole.collect()) == sorted(clean)
    cut = decontaminate.decontaminate(docs, benchmark, remove="spans").collect()
    left = [[w for i, w in enumerate(words(r[1])) if i not in h] for r, (_, h, _) in zip(rows, plain(rows, items))]
    assert sorted(words(r.text) for r in cut) == sorted(left)
    assert sum(r.text is None for r in cut) == sum(r[1] is None for r in rows)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    assert decontaminate.scan(docs, none).where("contaminated").count() == 0
    assert decontaminate.scan(docs.limit(0), none).count() == 0
    with pytest.raises(ValueError):
        decontaminate.decontaminate(docs, none, remove="lines")
