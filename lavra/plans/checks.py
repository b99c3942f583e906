"""Queries over models, folds and edge inputs whose results SQL can state."""

from __future__ import annotations

from pyspark.sql import functions as F

from lavra.operators import evaluate, explain, models, profile, ranking, sampling
from lavra.operators.sampling import group_folds
from lavra.plans import modelling
from lavra.plans.rankings import GROUPS
from lavra.plans.registry import query
from lavra.session import scratch_path, staged
from lavra.sources.payloads import header_row_table
from lavra.sources.scan import scan_quoted, scan_raw, scan_typed
from lavra.sources.sinks import load_run, save_run, write_json, write_layer

RISK_FOLDS = (
    "d as (select doc_id, source as grp, 1 - quality as y from documents join labels using (doc_id)), " + GROUPS.format(k=5)
)


@query(f"""with {RISK_FOLDS}
select count(*) as n, sum(y)::bigint as positives, 0::bigint as wrong_class, 0::bigint as outside, count(distinct doc_id) as n_documents
from d join f using (grp) where fold = 0""")
def prediction_checks(t):
    """Rows, true classes and the rule between score and class of the holdout predictions."""
    fitted, _, test = modelling._fitted(t)
    scored = models.predict(fitted, test, modelling.TARGET, ["doc_id"])
    by_score = (F.col("score") >= 0.5).cast("int")
    return scored.agg(
        F.count("*").alias("n"), F.sum("y_real").alias("positives"), F.count_if(F.col("y_pred") != by_score).alias("wrong_class"),
        F.count_if(~F.col("score").between(0, 1)).alias("outside"), F.count_distinct("doc_id").alias("n_documents"),
    )


@query(f"""with {RISK_FOLDS},
e as (select d.* from d join f using (grp) where fold > 0),
h as (select grp, count(*) as size, sum(y) as pos from e group by 1),
i as (select grp, row_number() over (order by size desc, pos, md5('42:' || grp)) as place from h),
j as (select grp, case when (place - 1) % 8 < 4 then (place - 1) % 8 else 7 - (place - 1) % 8 end as inner_fold from i)
select 'logistic_regression' as modelo, cast(inner_fold as int) as fold, count(*) as n, sum(y)::bigint as positives
from e join j using (grp) group by 1, 2""")
def cross_validation_rows(t):
    """Every training row is scored once, in its own inner fold."""
    train, _ = modelling._split(t)
    folded = staged(group_folds(train, modelling.GROUP, modelling.TARGET, 4), "inner")
    candidates = [(models.LOGISTIC.name, models.LOGISTIC, {})]
    scores = models.cross_predictions(folded, modelling.TARGET, modelling.NUMERIC, modelling.CATEGORICAL, candidates)
    return scores.groupBy("modelo", "fold").agg(F.count("*").alias("n"), F.sum("y_real").alias("positives"))


@query("""
select feature, repeat, count(*) as n, sum(l_quantity)::double as quantity, round(sum(l_discount), 4)::double as discount, sum(l_linenumber)::bigint as line_numbers
from lineitem, (values ('l_quantity'), ('l_discount')) f(feature), (values (1), (2)) r(repeat) group by 1, 2""")
def permutation_sums(t):
    """A permuted feature keeps its values, and so do all others."""
    rows = t.lineitem.select(
        F.concat_ws(".", "l_orderkey", "l_linenumber").alias("id"), "l_quantity", "l_discount", "l_linenumber"
    )
    copies = explain.permuted(rows, ["l_quantity", "l_discount"], "id", 2)
    return copies.groupBy("feature", "repeat").agg(
        F.count("*").alias("n"), F.round(F.sum("l_quantity"), 4).alias("quantity"), F.round(F.sum("l_discount"), 4).alias("discount"),
        F.sum("l_linenumber").alias("line_numbers"),
    )


@query("""select 'value' as feature, repeat, count(*) as n, 0::bigint as own, count(distinct o_orderkey) as n_values
from orders, (values (1), (2), (3)) r(repeat) group by repeat""")
def permutation_ring(t):
    """No row keeps its own value, and none is taken twice."""
    rows = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("value"), "o_orderstatus")
    return explain.permuted(rows, ["value"], "id", 3).groupBy("feature", "repeat").agg(
        F.count("*").alias("n"), F.count_if(F.col("value") == F.col("id")).alias("own"), F.count_distinct("value").alias("n_values")
    )


STRATA = """
with recursive d as (select o_custkey as grp, count(*)::hugeint as size, count(*) filter (o_orderstatus = 'F')::hugeint as pos from orders group by 1),
t as (select sum(size)::hugeint as rows, sum(pos)::hugeint as ones, count(*) as m from d),
p as (select grp, size, pos, row_number() over (order by size desc, pos desc, md5('42:' || grp)) as i from d),
r(i, sizes, ones, fold) as (
  select 0::bigint, [0, 0, 0, 0]::hugeint[], [0, 0, 0, 0]::hugeint[], -1
  union all
  select n.i, list_transform(range(4), lambda j: n.sizes[j + 1] + case when j = n.fold then n.size else 0 end),
    list_transform(range(4), lambda j: n.ones[j + 1] + case when j = n.fold then n.pos else 0 end), n.fold
  from (
    select r.i + 1 as i, r.sizes, r.ones, p.size, p.pos, (list_sort(list_transform(range(4), lambda j:
      {'cost': r.sizes[j + 1] * p.size * t.ones * t.ones + r.ones[j + 1] * p.pos * t.rows * t.rows, 'fold': j::int})))[1].fold as fold
    from r join p on p.i = r.i + 1, t) n)
select size::bigint as size, pos::bigint as positives, fold, count(*) as n_groups from r join p using (i) group by 1, 2, 3"""


@query(STRATA)
def stratified_folds(t):
    """Groups of each size and number of positives in every fold; packed one by one in the SQL."""
    rows = t.orders.select(F.col("o_custkey").alias("grp"), (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    folded = sampling.stratified_group_folds(rows, "grp", "y", 4)
    groups = folded.groupBy("grp", "fold").agg(F.count("*").alias("size"), F.sum("y").alias("positives"))
    return groups.groupBy("size", "positives", "fold").agg(F.count("*").alias("n_groups"))


@query(f"""with {modelling.SCORED},
r as (select l_linestatus, sum(fp * (ctp - tp / 2.0)) / (max(p) * max(n)) as roc_auc, sum(tp * ctp / (ctp + cfp)) / max(p) as pr_auc from k group by 1),
w as (select max(pr_auc) filter (l_linestatus = 'O') - max(pr_auc) filter (l_linestatus = 'F') as dp,
  max(roc_auc) filter (l_linestatus = 'O') - max(roc_auc) filter (l_linestatus = 'F') as dr from r)
select 'same' as pair, 0.0 as delta_pr_auc, 0.0 as delta_roc_auc, 'small' as interpretacao
union all select 'other', round(dp, 8) + 0.0, round(dr, 8) + 0.0, case when abs(dp) < 1e-4 and abs(dr) < 1e-4 then 'small' else 'large' end from w""")
def verdict_branches(t):
    """Both verdicts: a table against itself, and against another with a narrow limit."""
    scored = modelling._scored_lines(t)
    sides = {s: evaluate.binary_metrics(scored.where(F.col("l_linestatus") == s), "y", "score", "pred") for s in ("F", "O")}
    texts = {"small": "small", "large": "large"}
    out = []
    for pair, other, limit in (("same", "F", 0.02), ("other", "O", 1e-4)):
        found = evaluate.verdict(evaluate.compare_metrics(sides["F"], sides[other]), texts, limit)
        out.append(found.select(
            F.lit(pair).alias("pair"), *[(F.round(c, 8) + F.lit(0.0)).alias(c) for c in ("delta_pr_auc", "delta_roc_auc")], "interpretacao"
        ))
    return out[0].unionByName(out[1])


@query(f"""with {RISK_FOLDS}
select 'logistic_regression' as best_model, count(*) filter (fold > 0) as train_rows, count(*) filter (fold = 0) as test_rows,
  count(*) filter (fold = 0) as reloaded_rows, 0::bigint as changed, 42 as random_seed from d join f using (grp)""")
def saved_run(t):
    """A run written to a folder and read back: the model scores as before, the facts are the same."""
    fitted, train, test = modelling._fitted(t)
    test = staged(test, "test")
    before = models.predict(fitted, test, modelling.TARGET, ["doc_id"])
    facts = models.run_metadata(t.spark, fitted, modelling.TARGET, modelling.GROUP, [], {}, train.count(), test.count())
    folder = scratch_path(t.spark, "run")
    save_run(folder, fitted.model, before, facts)
    model, saved, described = load_run(t.spark, folder)
    after = models.predict(model, test, modelling.TARGET, ["doc_id"]).withColumnRenamed("score", "again")
    both = saved.join(after.select("doc_id", "again"), "doc_id").agg(
        F.count("*").alias("reloaded_rows"), F.count_if(F.col("score") != F.col("again")).alias("changed")
    )
    named = described.select("best_model", "train_rows", "test_rows", F.col("random_seed").cast("int").alias("random_seed"), F.lit(1).alias("_k"))
    return named.join(both.withColumn("_k", F.lit(1)), "_k").drop("_k")


@query("""
select o_orderkey, o_custkey, row_number() over (order by 9007199254740992 + o_orderkey % 7 desc, md5('' || o_orderkey)) as position,
  rank() over (order by 9007199254740992 + o_orderkey % 7 desc) as place from orders""")
def rank_large_numbers(t):
    """Whole numbers that differ by less than a double can tell."""
    large = (F.lit(2**53).cast("long") + F.col("o_orderkey") % 7).alias("large")
    rows = t.orders.select("o_orderkey", "o_custkey", large)
    ranked = ranking.competition_rank(rows, "large", "place")
    placed = ranking.row_position(ranked, [(F.col("large"), True)], ranking.key_hash(["o_orderkey"]), "position")
    return placed.select("o_orderkey", "o_custkey", "position", "place")


@query("""
select 'o_orderkey' as "column", 0::bigint as nulls, null::double as null_pct, 0::bigint as n_distinct
union all select 'o_orderstatus', 0, null, 0""")
def empty_profile(t):
    nothing = t.orders.select("o_orderkey", "o_orderstatus").where("o_orderkey < 0")
    return profile.column_profile(nothing).select("column", "nulls", "null_pct", "n_distinct")


@query("""
select c_custkey::varchar as code, c_name as name, case when c_custkey % 2 = 1 then c_mktsegment end as segment
from customer""")
def mixed_headers(t):
    """Payloads that name the same keys differently."""
    odd = F.col("c_custkey") % 2 == 1
    key, name = F.col("c_custkey").cast("string"), F.col("c_name")
    one = F.array(
        F.create_map(F.lit("a"), F.lit("code"), F.lit("b"), F.lit("name"), F.lit("c"), F.lit("segment")),
        F.create_map(F.lit("a"), key, F.lit("b"), name, F.lit("c"), F.col("c_mktsegment")),
    )
    two = F.array(
        F.create_map(F.lit("a"), F.lit("name"), F.lit("b"), F.lit("code")), F.create_map(F.lit("a"), name, F.lit("b"), key)
    )
    return header_row_table(t.customer.select(F.when(odd, one).otherwise(two).alias("p")), "p").select("code", "name", "segment")


@query("""select c_custkey::varchar as c_custkey, c_name || chr(10) || c_mktsegment as note from customer""")
def quoted_line_breaks(t):
    path = scratch_path(t.spark, "breaks")
    noted = t.customer.select("c_custkey", F.concat_ws("\n", "c_name", "c_mktsegment").alias("note"))
    write_layer(noted, path, "csv")
    return scan_raw(t.spark, path, multi_line=True)


@query("""select l_orderkey::varchar as l_orderkey, l_linenumber::varchar as l_linenumber,
  case when l_linenumber % 2 = 0 then l_returnflag || chr(10) || '"' || l_linestatus || '",' || chr(10) || 'x' else l_returnflag end as note from lineitem""")
def quoted_breaks_in_splits(t):
    """Quoted line breaks, quotes and commas, read without a task that holds a file."""
    path = scratch_path(t.spark, "breaks")
    note = F.when(F.col("l_linenumber") % 2 == 0, F.concat("l_returnflag", F.lit('\n"'), "l_linestatus", F.lit('",\nx'))).otherwise(F.col("l_returnflag"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", note.alias("note"))
    rows.write.options(header=True, escape='"').csv(path)
    return scan_quoted(t.spark, path)


@query("""
select n, sum(size)::bigint as rows from (
  select count(distinct fold) as n, count(*) as size from (
    select c_custkey, case when c_custkey % 3 > 0 then c_nationkey end as g, 0 as fold from customer) where g is not null group by g)
group by n union all select 0, count(*) from customer where c_custkey % 3 = 0""")
def folds_without_group(t):
    """A group has one fold; rows without a group (counted under 0) all have one too."""
    rows = t.customer.select(
        "c_custkey", F.when(F.col("c_custkey") % 3 > 0, F.col("c_nationkey")).alias("g"), (F.col("c_acctbal") > 0).cast("int").alias("y")
    )
    folded = staged(sampling.group_folds(rows, "g", "y", 4), "folded").where(F.col("fold").between(0, 3))
    sizes = folded.groupBy("g").agg(F.count_distinct("fold").alias("n"), F.count("*").alias("size"))
    number = F.when(F.col("g").isNull(), F.lit(0).cast("long")).otherwise(F.col("n"))
    return sizes.groupBy(number.alias("n")).agg(F.sum("size").alias("rows"))


@query("""select r_regionkey, r_name, length(r_name) as size from region""")
def typed_round_trip(t):
    """A layer as Parquet and as JSON lines; both read back the same."""
    folder = scratch_path(t.spark, "layer")
    named = t.region.select("r_regionkey", "r_name", F.length("r_name").alias("size"))
    write_layer(named, f"{folder}/parquet")
    write_json(named, f"{folder}/json")
    typed = scan_typed(t.spark, f"{folder}/parquet", named.schema)
    again = t.spark.read.schema(named.schema).json(f"{folder}/json")
    return typed.intersectAll(again)
