"""URL rules in a sorted array of 64-bit digests that every task memory-maps.

The index is one file: sorted xxhash64 digests of the rules' strings, the strings themselves and
their verdicts. It is written to the shared folder and handed to the executors by ``addFile``. A URL
asks for every suffix of its host with every prefix of its path that some rule has the length of; a
batch of such strings is searched at once by bisection, and a hit counts only if the stored string is
the same. Rules above the size bound are joined instead, with the same result.
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.llm.text import columns_of, lower_ascii
from lavra.session import scratch_path, staged

# Largest index, in bytes, that is built as one file.
INDEX_BYTES = 128 * 1024 * 1024
VERDICTS = ("allow", "block")
_HEAD = struct.Struct("<QQQ")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark or hash, A-Z lower-cased; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to a question mark or hash; else empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _prepared(rules: DataFrame) -> DataFrame:
    """Distinct rules: block wins where one is given with both verdicts."""
    known = rules.where(F.col("host").isNotNull() & F.col("verdict").isin(*VERDICTS))
    text = F.concat(lower_ascii(F.col("host")), F.coalesce("path", F.lit("")))
    shaped = known.select(text.alias("rule"), F.octet_length(F.coalesce("path", F.lit(""))).alias("length"), "verdict")
    return shaped.groupBy("rule", "length").agg(F.max("verdict").alias("verdict"))


def pack(rules: list[tuple[str, int, str]]) -> bytes:
    """The index file of (rule, bytes of its path, verdict) triples."""
    keyed = sorted((xxhash.xxh64_intdigest(r.encode()), r.encode(), v) for r, _, v in rules)
    digests = np.array([d for d, _, _ in keyed], "<u8")
    ends = np.cumsum([0, *(len(r) for _, r, _ in keyed)]).astype("<u8")
    blocked = bytes(v == "block" for _, _, v in keyed)
    lengths = np.array(sorted({n for _, n, _ in rules}), "<u8")
    parts = [_HEAD.pack(len(keyed), len(lengths), int(ends[-1])), digests, ends, lengths, blocked]
    return b"".join(bytes(p) for p in parts) + b"".join(r for _, r, _ in keyed)


class Index:
    """The packed rules, mapped from a file."""

    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, "r")
        count, lengths, size = _HEAD.unpack(data[: _HEAD.size].tobytes())
        at = _HEAD.size
        self.digests, at = data[at : at + 8 * count].view("<u8"), at + 8 * count
        self.ends, at = data[at : at + 8 * (count + 1)].view("<u8"), at + 8 * (count + 1)
        self.lengths, at = data[at : at + 8 * lengths].view("<u8").tolist(), at + 8 * lengths
        self.blocked, at = data[at : at + count], at + count
        self.strings = data[at : at + size]

    def find(self, asked: list[bytes]) -> list[int]:
        """Number of the rule that is each string, or -1."""
        if not asked or not len(self.digests):
            return [-1] * len(asked)
        digests = np.fromiter(map(xxhash.xxh64_intdigest, asked), "<u8", len(asked))
        first = np.searchsorted(self.digests, digests)
        found = np.full(len(asked), -1)
        inside = np.minimum(first, len(self.digests) - 1)
        for i in np.flatnonzero(self.digests[inside] == digests).tolist():
            at = int(first[i])
            while at < len(self.digests) and self.digests[at] == digests[i]:
                if self.strings[int(self.ends[at]) : int(self.ends[at + 1])].tobytes() == asked[i]:
                    found[i] = at
                at += 1
        return found.tolist()


def questions(host: str, path: str, lengths: list[int]) -> list[bytes]:
    """Strings of the rules that could fit, the winner first.

    The longest string (UTF-8 bytes) wins; of two of one length the one with the longer host.
    """
    if not host and not path:
        return []
    labels, raw = host.split("."), path.encode()
    hosts = [".".join(labels[i:]).encode() for i in range(len(labels))]
    # A cut inside a character is no beginning of a path.
    cuts = [n for n in lengths if n <= len(raw) and (n == len(raw) or raw[n] & 0xC0 != 0x80)]
    asked = [(len(h) + n, len(h), h + raw[:n]) for h in hosts for n in cuts]
    return [text for *_, text in sorted(asked, reverse=True)]


def judge(index: Index, hosts: list[str | None], paths: list[str | None], default: str) -> list[tuple[str | None, str]]:
    asked: list[bytes] = []
    ends = [0]
    for host, path in zip(hosts, paths):
        asked += questions(host or "", path or "", index.lengths)
        ends.append(len(asked))
    found = index.find(asked)
    out = []
    for a, b in zip(ends, ends[1:]):
        hit = next((i for i in range(a, b) if found[i] >= 0), None)
        out.append((None, default) if hit is None else (asked[hit].decode(), VERDICTS[index.blocked[found[hit]]]))
    return out


def _shared_file(spark: SparkSession, data: bytes) -> str:
    """Write one file to the shared folder and have every executor fetch it; the name it goes by."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'urls')}/{uuid.uuid4().hex}.index")
    out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    context.addFile(path.toUri().toString())
    return path.getName()


_open: dict[str, Index] = {}


def _verdicts(name: str, default: str):
    def run(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        if name not in _open:
            _open[name] = Index(SparkFiles.get(name))
        found = judge(_open[name], hosts.to_pylist(), paths.to_pylist(), default)
        rules, verdicts = [r for r, _ in found], [v for _, v in found]
        return pa.StructArray.from_arrays([pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], ["rule", "verdict"])

    return F.arrow_udf(run, "rule string, verdict string")


def _joined(urls: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same verdicts for rules of any number: the strings a URL asks for are joined with them."""
    lengths = [r.length for r in rules.select("length").distinct().collect()]
    rows = staged(urls.withColumn("_row", F.monotonically_increasing_id()), "urls")

    def ask(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        pairs = zip(hosts.to_pylist(), paths.to_pylist())
        return pa.array([[q.decode() for q in questions(h, p, lengths)] for h, p in pairs], pa.list_(pa.string()))

    asked = rows.select("_row", F.posexplode(F.arrow_udf(ask, "array<string>")("host", "path")).alias("_place", "rule"))
    best = asked.join(rules, "rule").groupBy("_row").agg(F.min_by(F.struct("rule", "verdict"), "_place").alias("_v"))
    return rows.join(best, "_row", "left").drop("_row").withColumn(
        "_v", F.coalesce("_v", F.struct(F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")))
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url", index_bytes: int = INDEX_BYTES
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` of every URL.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block). A rule fits its host and all
    subdomains where the path starts with the rule's; the longest string host + path wins, of equal
    lengths the longer host; of one string with both verdicts, block. Rules without a host or with
    another verdict are passed over. A URL that is in no rule is not in the list: it gets a null rule
    and ``default``. Null URLs and those without ``://`` have an empty host and path and fit no rule.
    Repeated pages each get their verdict; input columns named like the new ones are replaced.
    """
    new = ("host", "path", "rule", "verdict", "_v", "_row")
    rest = columns_of(pages, new)
    asked = pages.select(*rest, url_host(F.col(f"`{url}`")).alias("host"), url_path(F.col(f"`{url}`")).alias("path"))
    ready = staged(_prepared(rules), "rules")
    size = ready.agg(F.sum(F.octet_length("rule") + 17)).first()[0] or 0
    if size <= index_bytes:
        packed = pack([tuple(r) for r in ready.collect()])
        name = _shared_file(pages.sparkSession, packed)
        judged = asked.withColumn("_v", _verdicts(name, default)("host", "path"))
    else:
        judged = _joined(asked, ready, default)
    return judged.select(*rest, "host", "path", F.col("_v.rule").alias("rule"), F.col("_v.verdict").alias("verdict"))
