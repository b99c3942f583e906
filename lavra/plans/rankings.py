"""Queries that rank, number, sample and split."""

from __future__ import annotations

from pyspark.sql import functions as F

from lavra.operators import ranking, sampling
from lavra.operators.aggregate import score_rollup
from lavra.operators.joins import enrich
from lavra.plans.registry import query
from lavra.session import staged


def _spend(t):
    spend = staged(t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("spend")), "sums")
    customer = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    return staged(enrich(customer, spend, ["o_custkey"]), "spend")


SPEND = """s as (select c_custkey as o_custkey, c_nationkey, c_mktsegment, spend from customer
  left join (select o_custkey, round(sum(o_totalprice), 2) as spend from orders group by 1) on o_custkey = c_custkey)"""


@query(f"""with {SPEND}
select o_custkey, spend, case when spend is not null then rank() over (order by spend desc nulls last) end as place
from s""")
def rank_global(t):
    return ranking.competition_rank(_spend(t), "spend", "place").select("o_custkey", "spend", "place")


@query("""
select l_orderkey, l_linenumber, l_quantity, rank() over (order by l_quantity desc) as place from lineitem""")
def rank_with_ties(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return ranking.competition_rank(rows, "l_quantity", "place")


@query(f"""with {SPEND}
select o_custkey, c_nationkey, spend, case when spend is not null and c_nationkey is not null
  then rank() over (partition by c_nationkey order by spend desc nulls last) end as place from s""")
def rank_in_group(t):
    return ranking.rank_in_group(_spend(t), ["c_nationkey"], "spend", "place").select(
        "o_custkey", "c_nationkey", "spend", "place"
    )


@query(f"""with {SPEND}
select o_custkey, c_mktsegment, spend, case when length(c_mktsegment) = 9 and spend is not null then
  rank() over (order by case when length(c_mktsegment) = 9 then spend end desc nulls last) end as place from s""")
def rank_masked(t):
    eligible = F.col("c_mktsegment").isNotNull() & (F.length("c_mktsegment") == 9)
    return ranking.competition_rank(_spend(t), "spend", "place", where=eligible).select(
        "o_custkey", "c_mktsegment", "spend", "place"
    )


ROLLUP_NAMES = {
    "rows": "n_orders", "mean": "mean_score", "predicted": "predicted", "actual": "actual",
    "mean_pct": "mean_pct", "eligible": "eligible",
}


def _scores(t):
    """A closed-form score per order, standing in for a model's probability."""
    # The product is rounded, as SQL does it: ``round`` to 4 places looks at the decimal digits, where halves fall otherwise.
    score = F.round(F.col("o_totalprice") / 600000 * 10000) / 10000
    return t.orders.select(
        "o_custkey", score.alias("score"), (score >= 0.5).cast("int").alias("pred"),
        (F.col("o_orderstatus") == "F").cast("int").alias("real"),
    )


ROLLUP = """r as (select o_custkey, count(*) as n_orders, round(avg(score), 10) as mean_score,
  sum(cast(score >= 0.5 as int))::bigint as predicted, sum(real)::bigint as actual, count(*) >= 5 as eligible
  from (select o_custkey, round(o_totalprice / 600000, 4) as score, cast(o_orderstatus = 'F' as int) as real from orders)
  group by 1)"""


def _rolled(t):
    rolled = score_rollup(_scores(t), ["o_custkey", "absent"], "score", "pred", "real", ROLLUP_NAMES)
    return rolled.withColumn("mean_score", F.round("mean_score", 10)).drop("mean_pct")


@query(f"with {ROLLUP} select *, round(mean_score * 100, 8) as mean_pct from r")
def risk_rollup(t):
    return _rolled(t).withColumn("mean_pct", F.round(F.col("mean_score") * 100, 8))


@query(f"""with {ROLLUP}
select *, row_number() over (order by mean_score desc, md5(cast(o_custkey as varchar))) as place
from r where eligible""")
def ranking_list(t):
    return ranking.ranking_list(staged(_rolled(t), "rolled"), "mean_score", ["o_custkey"], "place", F.col("eligible"))


@query(f"""with {SPEND}
select o_custkey, spend from s order by spend desc nulls last, o_custkey limit 25""")
def top_k(t):
    return ranking.top_k(_spend(t), 25, "spend", ["o_custkey"]).select("o_custkey", "spend")


@query("select c_custkey, c_acctbal from customer order by c_acctbal, c_custkey limit 20")
def bottom_k(t):
    return ranking.bottom_k(t.customer.select("c_custkey", "c_acctbal"), 20, "c_acctbal", ["c_custkey"])


@query("""
select l_suppkey, n from (select l_suppkey, count(*) as n from lineitem group by 1) order by n desc, l_suppkey limit 1""")
def best_row(t):
    counts = t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n"))
    return ranking.best_row(counts, F.struct("n", -F.col("l_suppkey")))


@query("""
select o_orderkey, o_custkey, o_totalprice from
  (select *, md5('42:' || o_orderkey) as h from orders order by h, o_orderkey limit 5000)""")
def sample_exact(t):
    return sampling.sample_exact(t.orders, sampling.SAMPLE_ROWS, ["o_orderkey"]).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


GROUPS = """g as (select grp, count(*) as size, sum(y) as pos from d group by 1),
p as (select grp, row_number() over (order by size desc, pos, md5('42:' || grp)) as place from g),
f as (select grp, case when (place - 1) % (2 * k) < k then (place - 1) % (2 * k)
  else 2 * k - 1 - (place - 1) % (2 * k) end as fold from p, (select {k} as k))"""


@query("""with d as (select doc_id, source as grp, quality as y from documents join labels using (doc_id)), """
       + GROUPS.format(k=5) + " select doc_id, grp, y, cast(fold as int) as fold from d join f using (grp)")
def group_folds(t):
    docs = enrich(t.labels, t.documents.select("doc_id", "source"), ["doc_id"])
    rows = docs.select("doc_id", F.col("source").alias("grp"), F.col("quality").alias("y"))
    return sampling.group_folds(rows, "grp", "y", 5)


@query("""with d as (select l_linenumber, l_suppkey,
  coalesce(cast(case when l_orderkey % 10 <> 0 then l_orderkey end as varchar),
    'SEM_ESCOLA_' || l_orderkey || '.' || l_linenumber) as grp, cast(l_returnflag = 'R' as int) as y from lineitem), """
       + GROUPS.format(k=4) + " select grp, count(*) as n, sum(y)::bigint as positives, cast(fold as int) as fold from d join f using (grp) group by grp, fold")
def group_folds_by_order(t):
    row_id = F.concat_ws(".", "l_orderkey", "l_linenumber")
    known = F.when(F.col("l_orderkey") % 10 != 0, F.col("l_orderkey"))
    rows = t.lineitem.select(
        sampling.fallback_group(known, row_id).alias("grp"), (F.col("l_returnflag") == "R").cast("int").alias("y")
    )
    folds = sampling.group_folds(rows, "grp", "y", 4)
    return folds.groupBy("grp", "fold").agg(F.count("*").alias("n"), F.sum("y").alias("positives"))


@query("""with d as (select doc_id, source as grp, quality as y from documents join labels using (doc_id)), """
       + GROUPS.format(k=5) + """
select fold = 0 as is_test, count(*) as n, sum(y)::bigint as positives, count(distinct grp) as n_groups
from d join f using (grp) group by 1""")
def holdout_split(t):
    docs = enrich(t.labels, t.documents.select("doc_id", "source"), ["doc_id"])
    folded = sampling.group_folds(docs, "source", "quality", 5)
    train, test = sampling.holdout(folded)
    both = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    return both.groupBy("is_test").agg(
        F.count("*").alias("n"), F.sum("quality").alias("positives"), F.count_distinct("source").alias("n_groups")
    )
