"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its shuffled documents, repeated as often as its target asks for. A
document's virtual finish time is the words its source has sent with it, divided by the source's
target. All queues together, in order of finish time, are the mix; it ends where the total budget is
used up. Since every queue runs at the pace of its target, each source is within about one document
of its target wherever the mix is cut.

Nothing is ordered in one task. The shuffle key is uniform, so its leading bits deal a source of any
size into even buckets; sums of buckets, one row each, give every bucket what lies ahead of it. The
mix is dealt into ranges of the finish time in the same way, and only the range that holds the cut is
summed document by document.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lavra.llm.text import WORD, columns_of
from lavra.session import staged

# Leading bits of the shuffle key that name a bucket of a source.
BUCKET_BITS = 12
# Parts that the time up to 2, and then the part that holds the cut, are searched in.
PARTS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(columns: list[Column], seed: str) -> Column:
    """60 uniform bits of an md5, the same in any engine; null and empty differ."""
    fields = [F.coalesce(c.cast("string"), F.lit("\\N")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), *fields)), 1, 15), 16, 10).cast("long")


def _numbered(sources: DataFrame) -> DataFrame:
    """``place`` of every source by code point, null last, by ranges of names instead of one sort."""
    n = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = staged(
        sources.repartitionByRange(n, F.col("source").asc_nulls_last()).withColumn("_part", F.spark_partition_id()),
        "sources",
    )
    counts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    ahead = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    inside = F.row_number().over(W.partitionBy("_part").orderBy(F.col("source").asc_nulls_last())) - 1
    return dealt.withColumn("_in", inside).join(ahead, "_part").select("source", "source_size", (F.col("_ahead") + F.col("_in")).alias("place"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """``source, source_size, target`` of a table ``source, source_size``.

    The weights go round the sources in code point order, null last. Sources share ``share`` of all
    sizes by weight; a target stops at ``most`` times its source's size and the excess goes to the
    others by weight, again until no target is above.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    table = staged(_numbered(sizes).withColumn("weight", weight), "weights")
    limit = F.lit(most) * F.col("source_size")
    budget = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    level = -1.0
    while True:
        # Sources that stop below the level reached so far; each turn raises it.
        stopped = limit <= F.col("weight") * F.lit(level)
        given, open_weight = table.agg(F.sum(F.when(stopped, limit)), F.sum(F.when(~stopped, F.col("weight")))).first()
        if not open_weight:
            break
        higher = (budget - (given or 0.0)) / open_weight
        if higher <= level:
            break
        level = higher
    target = F.least(limit, F.col("weight") * F.lit(level)) if open_weight else limit
    return table.select("source", "source_size", target.cast("double").alias("target"))


def schedule(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    seed: str = "mix",
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """The carried columns of ``docs``, all by default, with ``size, source_size, target, finish, taken``.

    ``size`` is the number of words (null: 0); ``taken`` the words the mix takes of the document over
    all its turns; ``finish`` the finish time of its first turn. The document that the budget ends in
    is taken up to the budget, all others whole in each turn. Sources by code point, null last; a
    source without words has target 0 and nothing is taken from it. The order inside a source is a
    hash of seed, key and text; rows equal in both follow each other in any order, so equal rows may
    differ in ``taken`` but their set does not. Input columns named like the new ones are replaced.
    An empty table stays empty.
    """
    new = ("size", "source_size", "target", "finish", "taken")
    rest = [c for c in (docs.columns if carry is None else carry) if c not in new]
    own = F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_doc")
    sized = docs.select(
        own, F.col(f"`{source}`").alias("source"), word_count(F.col(f"`{text}`")).alias("size"),
        shuffle_key([F.col(f"`{key}`"), F.md5(F.col(f"`{text}`"))], seed).alias("_key"),
    )
    bucket = F.shiftright("_key", 60 - BUCKET_BITS).cast("int")
    rows = staged(sized.withColumn("_bucket", bucket), "sizes")
    buckets = rows.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    targets = staged(
        source_targets(buckets.groupBy("source").agg(F.sum("_sum").alias("source_size")), weights, share, most), "targets"
    )
    ahead = W.partitionBy("source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = buckets.select("source", "_bucket", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_ahead"))
    known = offsets.alias("o").join(targets.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source"))).select(
        F.col("o.source").alias("_source"), F.col("_bucket").alias("_b"), "_ahead", "source_size", "target"
    )
    inside = W.partitionBy("source", "_bucket").orderBy("_key", "size").rowsBetween(W.unboundedPreceding, 0)
    local = rows.withColumn("_in", F.sum("size").over(inside))
    placed = local.join(known, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_bucket") == F.col("_b")))
    # With no words taken before it, a document ends at its own size: words sent by its source so far.
    sent = (F.col("_ahead") + F.col("_in")).alias("_sent")
    queue = staged(placed.select("_doc", "source", "size", "source_size", "target", "_key", sent), "queue")
    return _cut(queue, math.ceil(most), share).select("_doc.*", "size", "source_size", "target", "finish", "taken")


def _crossing(sends: DataFrame, ahead: int, budget: int) -> Row | None:
    """The part that the budget ends in, with the words ahead of it; one row per part is ordered."""
    sums = sends.groupBy("_part").agg(F.sum("size").alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    placed = sums.withColumn("_ahead", F.coalesce(F.sum("_n").over(before), F.lit(0)) + F.lit(ahead))
    return placed.where((F.col("_ahead") <= budget) & (F.col("_ahead") + F.col("_n") > budget)).first()


def _cut(queue: DataFrame, turns: int, share: float) -> DataFrame:
    """The queue with ``finish`` and ``taken``: all turns in order of finish time up to the budget."""
    def finish(turn: int) -> Column:
        return (F.col("_sent") + F.lit(turn) * F.col("source_size")) / F.col("target")

    waiting = queue.where("size > 0 and target > 0")
    each = F.explode(F.array(*[F.struct(finish(t).alias("finish"), F.lit(t).alias("turn")) for t in range(turns)]))
    sends = waiting.select("size", "source", "_key", each.alias("s")).select("size", "source", "_key", "s.*")
    budget = math.floor(share * (queue.agg(F.sum("size")).first()[0] or 0))

    # Targets add up to the budget, so the cut is near time 1; times far behind it share a part.
    scaled = F.least(F.col("finish") * F.lit(PARTS // 2), F.lit(PARTS - 1.0))
    part, last, ahead = F.floor(scaled).cast("int"), None, 0
    inner = F.floor((scaled - F.floor(scaled)) * F.lit(PARTS)).cast("int")
    for level in (part, inner):
        found = _crossing(sends.withColumn("_part", level), ahead, budget)
        if found is None:
            break
        sends, ahead = sends.where(level == found["_part"]), found["_ahead"]
    else:
        order = ["finish", F.col("source").asc_nulls_last(), "_key", "turn", "size"]
        so_far = F.sum("size").over(W.partitionBy(F.lit(0)).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
        last = sends.withColumn("_sum", so_far).where(F.col("_sum") + ahead > budget).orderBy(*order).first()
        left = budget - (ahead + last["_sum"] - last["size"])

    def words(turn: int) -> Column:
        if last is None:
            return F.col("size")
        names = ("finish", "unnamed", "source", "key", "turn", "size")
        kinds = ("double", "boolean", "string", "long", "int", "long")

        def point(*values: Column) -> Column:
            return F.struct(*[v.cast(k).alias(n) for v, k, n in zip(values, kinds, names)])

        at = (last["finish"], last["source"] is None, last["source"] or "", last["_key"], last["turn"], last["size"])
        cut = point(*map(F.lit, at))
        unnamed, source = F.col("source").isNull(), F.coalesce("source", F.lit(""))
        here = point(finish(turn), unnamed, source, F.col("_key"), F.lit(turn), F.col("size"))
        return F.when(here < cut, F.col("size")).when(here == cut, F.lit(left)).otherwise(F.lit(0))

    taken = sum((words(t) for t in range(1, turns)), words(0))
    able = (F.col("size") > 0) & (F.col("target") > 0)
    return queue.select(
        "*", F.when(able, finish(0)).alias("finish"), F.when(able, taken).otherwise(F.lit(0)).cast("long").alias("taken")
    )


def mix(
    docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", ordered: bool = True, **options
) -> DataFrame:
    """The mix itself: rows of ``docs`` in order of finish time, a row for each turn that is taken.

    The document that the budget ends in is taken whole if at least half of it is. Columns are those
    of ``docs``, whatever their names. Only keys, sizes and hashes pass through the queues and the cut; the texts meet their
    finish times once, and move once more only if they are to be ``ordered``. Rows equal in key and text are numbered on both
    sides, so each gets one place in the queue. Null and empty texts have no words and are not taken; an empty table
    gives an empty mix.
    """
    digest = F.xxhash64(f"`{text}`")
    thin = docs.withColumn("_digest", digest)
    placed = schedule(thin, text=text, source=source, key=key, carry=[key, "_digest"], **options)
    turns = F.sequence(F.lit(0), F.round(F.col("taken") / F.col("size")).cast("int") - 1)
    pace = F.col("source_size") / F.col("target")
    taken = staged(
        placed.where("2 * taken >= size and taken > 0").select(
            F.col(f"`{key}`").alias("_k"), "_digest", "finish", F.transform(turns, lambda t: F.col("finish") + t * pace).alias("_times")
        ),
        "taken",
    )
    own = docs.select(F.struct(*columns_of(docs)).alias("_doc"), F.col(f"`{key}`").alias("_k"), digest.alias("_digest"))
    same = lambda a, b: F.col(f"{a}._k").eqNullSafe(F.col(f"{b}._k")) & (F.col(f"{a}._digest") == F.col(f"{b}._digest"))
    keys = docs.select(F.col(f"`{key}`").alias("_k"), digest.alias("_digest"))
    repeated = staged(keys.groupBy("_k", "_digest").agg(F.count("*").alias("_n")).where("_n > 1"), "repeated")
    if repeated.limit(1).count():
        again = W.partitionBy("_k", "_digest")
        several = own.alias("l").join(repeated.alias("r"), same("l", "r"), "left_semi")
        several = several.withColumn("_n", F.row_number().over(again.orderBy(F.xxhash64("_doc"))))
        places = taken.alias("l").join(repeated.alias("r"), same("l", "r"), "left_semi")
        places = places.withColumn("_n", F.row_number().over(again.orderBy("finish")))
        met = several.alias("l").join(places.alias("r"), same("l", "r") & (F.col("l._n") == F.col("r._n"))).select("_doc", "_times")
        own, taken = (x.alias("l").join(repeated.alias("r"), same("l", "r"), "left_anti") for x in (own, taken))
        joined = own.alias("l").join(taken.alias("r"), same("l", "r")).select("_doc", "_times").unionByName(met)
    else:
        joined = own.alias("l").join(taken.alias("r"), same("l", "r")).select("_doc", "_times")
    sent = joined.select("_doc", F.explode("_times").alias("_when"))
    if ordered:
        sent = sent.repartitionByRange("_when").sortWithinPartitions("_when")
    return sent.select("_doc.*")
