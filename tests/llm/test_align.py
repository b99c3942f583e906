import hashlib
import json
import random

import numpy as np
import pyarrow as pa
import pytest

from lavra.llm import align
from lavra.llm.queries import TOKENIZERS
from tests.llm.data import SCHEMA, clashing, odd_rows, prose

pytest.importorskip("tokenizers")
pytest.importorskip("sentencepiece")

ODD = [
    None, "", "x ", "  ", " ", "a  b\n  c ", "﷐ q r", "▁x y", " lead", "t\t 　 x <|endoftext|> <s> </s> <0x41> y", "z" * 3000 + " b",
    "\x00 a \x1c b", "日本 語の　x", "a᠎ b", "don't we'LL", "é" * 50, "\r\n \r\n a\x85 b", "😀 👨‍👩‍👧 x", "1234 5678.90", " " * 5000,
]


def plain_tokens(text):
    """Ids and byte ranges of both sides by the libraries themselves; none where the bytes differ."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    if not text:
        return [], []
    first = Tokenizer.from_file(TOKENIZERS[0])
    first.encode_special_tokens = True
    letters = align.byte_letters()
    a = first.encode(" " + text, add_special_tokens=False).ids
    second = SentencePieceProcessor(model_file=TOKENIZERS[1])
    b = second.encode(text)
    sides = []
    for ids, told in (
        (a, lambda i: bytes(letters[c] for c in first.id_to_token(i))),
        (b, lambda i: bytes([i - 3]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()),
    ):
        at, tokens = 0, []
        for i in ids:
            tokens.append((i, at, at + len(told(i))))
            at = tokens[-1][2]
        if b"".join(map(told, ids)) != (" " + text).encode():
            return [], []
        sides.append(tokens)
    return sides


def plain(texts):
    docs = []
    for text in texts:
        a, b = plain_tokens(text)
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if low < e <= cut) for side in (a, b)))
            low = cut
        docs.append((len(a), len(b), groups, links))
    counts = {}
    for *_, links in docs:
        for pair in set(links):
            counts[pair] = counts.get(pair, 0) + 1
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(n, most.get(a, 0))
    out = []
    for a, b, groups, links in docs:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((a, b, len(groups), len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), digest))
    return out, counts


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("table_rows", [10**6, 0])
def test_alignment_is_that_of_plain_loops(spark, table_rows):
    rng = random.Random(2)
    texts = ODD + [prose(rng, n) for n in (3, 40, 200)] + [prose(rng, 200)] * 2
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    docs = clashing(spark.createDataFrame(rows, SCHEMA).repartition(3))
    found, pairs = align.align(docs, *TOKENIZERS, table_rows=table_rows, range_rows=200)
    want, counts = plain(texts)
    got = {r.doc_id: tuple(r[n] for n in NAMES) for r in found.collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert {(r.a, r.b): r.n for r in pairs.collect()} == counts
    assert set(found.columns) == set(docs.columns) | set(NAMES)


def test_odd_rows_and_empty_table(spark):
    rows = odd_rows()
    found = align.align(spark.createDataFrame(rows, SCHEMA), *TOKENIZERS, carry=["doc_id"])[0]
    want = plain([r[1] for r in rows])[0]
    assert sorted(str(tuple(r[n] for n in NAMES)) for r in found.collect()) == sorted(map(str, want))
    empty, pairs = align.align(spark.createDataFrame([], SCHEMA), *TOKENIZERS)
    assert empty.count() == 0 and pairs.count() == 0


def test_groups_as_text(spark):
    docs = spark.createDataFrame([(1, "hello world", None, None, 1)], SCHEMA)
    told = align.align(docs, *TOKENIZERS, digest=False)[0].first().groups_sha256
    a, b = plain_tokens("hello world")
    assert [i for g in told.split(";") for i in map(int, g.split("|")[0].split(","))] == [x[0] for x in a]
    assert [i for g in told.split(";") for i in map(int, g.split("|")[1].split(","))] == [x[0] for x in b]


def test_stretches_give_the_tokens_of_whole_texts():
    rng = random.Random(4)
    letters = "ab1.,'sé日 \n\t　▁<|>\x1c﷐"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(400)]
    coders = [align.tokenizer(p) for p in TOKENIZERS]
    for coder in coders:
        assert coder.local
    sides = align.encoded(pa.array(texts), coders)
    whole = [[align._whole(c, " " + t) if t else None for c in coders] for t in texts]
    for k, side in enumerate(sides):
        got = np.split(side.ids, np.cumsum(side.many)[:-1])
        for g, w in zip(got, whole):
            assert g.tolist() == (w[k].tolist() if all(x is not None for x in w) else [])


def test_fast_vocabulary_splits_every_character_alike():
    from tokenizers import Tokenizer

    coder = align.tokenizer(TOKENIZERS[0])
    assert coder.fast is not None
    # Every 37th code point between letters, numbers, white space and its like.
    points = [chr(c) for c in range(1, 0x110000, 37) if not 0xD800 <= c < 0xE000]
    texts = [f" a{c}b {c}1{c}{c} x  {c} \n{c}.{c}" for c in points]
    tokenizer = Tokenizer.from_file(TOKENIZERS[0])
    slow = tokenizer.encode_batch(texts, add_special_tokens=False)
    assert all(s.ids == coder.fast.encode_ordinary(t) for s, t in zip(slow, texts))


def test_other_vocabularies_are_read_as_they_are(tmp_path):
    with open(TOKENIZERS[0], encoding="utf-8") as f:
        told = json.load(f)
    told["pre_tokenizer"]["add_prefix_space"] = True
    path = tmp_path / "other.json"
    path.write_text(json.dumps(told), encoding="utf-8")
    coder = align.BytePairs(str(path))
    assert not coder.local and coder.fast is None
    sides = align.encoded(pa.array(["a b", None]), [coder, align.tokenizer(TOKENIZERS[1])])
    assert sides[0].ids.tolist() == coder.encode(" a b") and sides[0].many.tolist() == [2, 0]


def test_pairs_survive_packing():
    values, times = np.array([3, 5, 1 << 40]), np.array([1, 300, 2])
    got = align.unpack(align.pack(values, times))
    assert [x.tolist() for x in got] == [values.tolist(), times.tolist()]
    assert [len(x) for x in align.unpack(align.pack(values[:0], times[:0]))] == [0, 0]
