"""Quality rules whose cutoffs are certified on labelled documents, all in Spark SQL.

A rule rejects what scores above its cutoff. The rules' cutoffs go from loose to strict in steps, all rules together: a
step rejects what any rule rejects at it, and all that the steps before it reject. In every stratum (a language) the steps are tested in this
order on the labelled good documents, by an exact binomial test of "this step rejects more than the
allowed share of good documents". The strictest step up to which every test is passed becomes the stratum's.
Testing in a fixed order and stopping at the first failure needs no correction among steps, so all of the allowed share and
of a stratum's error level goes into each test; strata share the error level evenly (Bonferroni). So with probability
``1 - delta`` no stratum loses more than ``alpha`` of its good documents. Where labels are too few to tell, nothing is rejected.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lavra.llm.text import columns_of, spaced_words
from lavra.operators.joins import skew_join
from lavra.session import staged

SYMBOLS = r"[#*$%&|<>]"
REPEAT_WINDOW = 5
# Score of a rule, larger is worse, and its cutoffs from loose to strict, one for each step.
RULES = {
    "symbols": ("n_symbols / n_words", (2.0, 1.5, 1.0, 0.75, 0.5, 0.35, 0.25, 0.15)),
    "repeats": ("n_repeat_words / n_words", (0.2, 0.18, 0.16, 0.14, 0.12, 0.1, 0.08, 0.06)),
    "lines": ("100.0D * n_dup_lines / n_words", (20.0, 15.0, 10.0, 7.0, 5.0, 4.0, 3.0, 2.0)),
    "length": ("word_chars / n_words", (40.0, 30.0, 25.0, 20.0, 17.0, 15.0, 13.0, 12.0)),
}
ALPHA, DELTA, STEPS = 0.02, 0.05, 8
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def _repeat_words(words: str, hashes: str) -> Column:
    """Words in windows that the text holds at least twice."""

    def twice(pairs: Column) -> Column:
        def same(j: Column, k: Column) -> Column:
            return F.get(pairs, j)["h"] == F.get(pairs, k)["h"]

        places = F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), lambda j: same(j, j - 1) | same(j, j + 1))
        covered = F.transform(places, lambda j: F.sequence(F.get(pairs, j)["i"], F.get(pairs, j)["i"] + REPEAT_WINDOW - 1))
        return F.size(F.array_distinct(F.flatten(covered)))

    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    found = F.transform(F.array(pairs), twice)[0]
    # Most texts repeat nothing, which a hash set of the windows shows without sorting them.
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), found).otherwise(F.lit(0)).cast("long")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the metrics of whole texts and ``base_failed``.

    Null and empty texts have no words and fail. Windows are told apart by 64-bit hashes of their
    words. Very long texts are measured whole; an empty table stays empty. Columns of the input named like a metric are replaced.
    """
    rest = columns_of(docs, (*METRICS, "_words", "_hashes", "_whole"))
    value = F.col(f"`{text}`")
    words = docs.select(*rest, value.alias("_whole"), spaced_words(value).alias("_words"))
    count = F.size("_words")

    def windows(w: Column) -> Column:
        starts = F.when(F.size(w) >= REPEAT_WINDOW, F.sequence(F.lit(0), F.size(w) - REPEAT_WINDOW))
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(REPEAT_WINDOW)]))

    hashed = words.withColumn("_hashes", F.coalesce(F.transform(F.array("_words"), windows)[0], F.array().cast("array<long>")))
    lines = F.filter(F.split("_whole", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def repeated(lines: Column) -> Column:
        return F.size(lines) - F.size(F.array_distinct(lines))

    measured = hashed.select(
        *rest,
        count.cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.coalesce(F.regexp_count("_whole", F.lit(SYMBOLS)), F.lit(0)).cast("long").alias("n_symbols"),
        F.coalesce(F.transform(F.array(lines), repeated)[0], F.lit(0)).cast("long").alias("n_dup_lines"),
        _repeat_words("_words", "_hashes").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measured.withColumn("base_failed", failed)


def score(rule: str) -> Column:
    return F.when(F.col("n_words") > 0, F.expr(RULES[rule][0]))


def labelled_keys(labels: DataFrame, key: str = "doc_id", quality: str = "quality", holdout: int | None = None) -> DataFrame:
    """``_key, good`` of the holdout: labels without contradiction, all unless ``holdout`` asks for about so many."""
    known = labels.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{quality}`").isNotNull())
    single = known.groupBy(F.col(f"`{key}`").alias("_key")).agg(
        F.min(f"`{quality}`").alias("_low"), F.max(f"`{quality}`").alias("_high")
    ).where("_low = _high").select("_key", (F.col("_low") == 1).alias("good"))
    share = 1 if holdout is None else holdout / max(1, single.count())
    if share >= 1:
        return single
    # The leading bits of an md5 are uniform, so this share of the labels lies below the limit.
    place = F.conv(F.substring(F.md5(F.col("_key").cast("string")), 1, 15), 16, 10).cast("long")
    return single.where(place < int(share * 2**60))


def tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of a binomial count, summed term by term from 0 in logarithms."""
    odds = math.log(p / (1 - p))
    start = n * F.lit(math.log1p(-p))
    first = F.struct(start.cast("double").alias("t"), F.exp(start).alias("s"))

    def add(acc: Column, j: Column) -> Column:
        t = acc["t"] + F.log((n - j + 1) / j) + F.lit(odds)
        return F.struct(t.alias("t"), (acc["s"] + F.exp(t)).alias("s"))

    return F.when(k > 0, F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1))), first, add)["s"]).otherwise(F.exp(start))


def rejected(step: Column | int) -> Column:
    """Whether any rule rejects a measured row at a step; no step (null) rejects nothing."""
    place = (F.lit(step) if isinstance(step, int) else step) + 1
    hit = F.lit(False)
    for rule, (_, cuts) in RULES.items():
        hit = hit | F.coalesce(score(rule) > F.try_element_at(F.array(*map(F.lit, cuts)), place), F.lit(False))
    return hit


def _named(stratum: Column) -> Column:
    """A stratum as a text that is never null, for joins; null is a stratum of its own."""
    return F.coalesce(F.concat(F.lit("="), stratum.cast("string")), F.lit(""))


def certify(measured: DataFrame, holdout: DataFrame, stratum: str = "lang", key: str = "doc_id", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``_stratum`` (as ``_named``) and ``_step`` of the strata that have a certified step.

    ``measured`` needs the rows of the holdout only. Labels and metrics meet by a shuffle, without texts. A key that
    several rows of a stratum have counts once, as rejected if any of its rows is. A
    stratum with a certified step has at least ``log(delta / strata) / log(1 - alpha)`` labels: 217 with four strata.
    """
    scores = measured.where("not base_failed").select(
        F.col(f"`{key}`").alias("_label"), _named(F.col(f"`{stratum}`")).alias("_stratum"), *METRICS[:-1]
    )
    labelled = scores.join(holdout.where("good"), F.col("_label") == F.col("_key"))
    single = labelled.groupBy("_key", "_stratum").agg(*[F.max(rejected(j)).alias(f"_r{j}") for j in range(STEPS)])
    counts = single.groupBy("_stratum").agg(F.count("*").alias("n"), *[F.count_if(f"_r{j}").alias(f"_k{j}") for j in range(STEPS)])
    # One row a stratum and step.
    tests = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.col(f"_k{j}").alias("k")) for j in range(STEPS)]))
    strata = W.partitionBy(F.lit(0))
    each = counts.withColumn("m", F.count("*").over(strata)).select("_stratum", "n", "m", tests.alias("t")).select("_stratum", "n", "m", "t.*")
    # At or above the mean the tail is near a half or more: no need to sum it.
    low = F.col("k") < F.col("n") * alpha
    passed = low & (tail(F.least("k", F.ceil(F.col("n") * alpha)), F.col("n"), alpha) <= F.lit(delta) / F.col("m"))
    order = W.partitionBy("_stratum").orderBy("j").rowsBetween(W.unboundedPreceding, 0)
    certified = each.withColumn("ok", F.min(passed.cast("int")).over(order)).where("ok = 1")
    return certified.groupBy("_stratum").agg(F.max("j").alias("_step"))


def judge(measured: DataFrame, steps: DataFrame, stratum: str = "lang") -> DataFrame:
    """``measured`` with ``kept``: not failed, and no rule's score above its cutoff at the step of its stratum.

    The few rows of the steps are broadcast once their size is known to be small, and else meet by a shuffle.
    """
    named = measured.withColumn("_stratum", _named(F.col(f"`{stratum}`")))
    joined = skew_join(named, steps, ["_stratum"])
    return joined.withColumn("kept", ~F.col("base_failed") & ~rejected(F.col("_step"))).drop("_stratum", "_step")


def apply_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", key: str = "doc_id", text: str = "text", **levels) -> DataFrame:
    """The documents that the rules keep, with the columns of ``docs``, whatever they are called.

    Documents whose text fails the base go; with no labels, or too few, nothing else does. A null
    stratum is a stratum of its own. Labels that contradict each other, or without a key, are not
    used; labels of unknown documents meet nothing; repeated documents are judged alike.
    """
    holdout = labelled_keys(labels, key)
    own = docs.select(
        F.struct(*columns_of(docs)).alias("_doc"), F.col(f"`{text}`").alias("_text"),
        F.col(f"`{stratum}`").alias("_level"), F.col(f"`{key}`").alias("_id"),
    )
    # Written, so that the cutoffs and the judgement share one pass over the texts.
    measured = staged(measure(own, "_text").drop("_text"), "metrics")
    steps = staged(certify(measured, holdout, "_level", "_id", **levels), "steps")
    return judge(measured, steps, "_level").where("kept").select("_doc.*")
