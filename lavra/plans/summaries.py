"""Queries that summarise, profile and check tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lavra.functions.indicators import category_flag
from lavra.operators import aggregate, profile
from lavra.operators.columns import (
    constant_columns as constants, curate, drop_leakage, numeric_and_categorical,
)
from lavra.operators.joins import enrich
from lavra.plans.registry import query


@query("""
select l_suppkey, count(*) as n_lines, min(l_linestatus) as line_status, min(l_returnflag) as return_flag,
  round(avg(case when l_returnflag = 'R' then 1.0 else 0 end) * 100, 6) as pct_returned,
  round(avg(case when l_linenumber = 1 then 1.0 else 0 end) * 100, 6) as pct_first,
  round(avg(case when l_discount > 0 then case when l_discount > 0.05 then 1.0 else 0 end end) * 100, 6)
    as pct_deep_discount,
  round(avg(l_quantity), 6) as avg_quantity, avg(cast(round(l_extendedprice * 100) as bigint)) as avg_price_cents
from lineitem group by 1""")
def entity_rollup(t):
    lines = t.lineitem.withColumns({
        "returned": category_flag(F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 2), 1),
        "first": category_flag(F.col("l_linenumber"), 1),
        "cents": _cents("l_extendedprice"),
        "deep": F.when(F.col("l_discount") > 0, (F.col("l_discount") > 0.05).cast("int")),
    })
    rolled = aggregate.entity_rollup(
        lines, ["l_suppkey"], "n_lines",
        {"l_linestatus": "line_status", "l_returnflag": "return_flag", "l_absent": "absent"},
        {"returned": "pct_returned", "first": "pct_first", "deep": "pct_deep_discount"},
        {"l_quantity": "avg_quantity", "cents": "avg_price_cents"},
    )
    rounded = ("pct_returned", "pct_first", "pct_deep_discount", "avg_quantity")
    return rolled.withColumns({c: F.round(c, 6) for c in rounded})


def _cents(column):
    return F.round(F.col(column) * 100).cast("long")


GROUP_SQL = """
select n_name, count(distinct o_custkey) as customers,
  avg(cast(round(o_totalprice * 100) as bigint)) as avg_price_cents,
  avg(cast(round(c_acctbal * 100) as bigint)) as avg_balance_cents,
  round(avg(case when o_totalprice >= c_acctbal * 50 then 1.0 else 0 end) * 100, 6) as pct_attained
from orders left join customer on o_custkey = c_custkey
left join (select * from nation where n_nationkey <> 3) on n_nationkey = c_nationkey group by 1"""


@query(GROUP_SQL)
def group_summary(t):
    customer = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_acctbal", F.col("c_nationkey").alias("n_nationkey"))
    nation = t.nation.where("n_nationkey <> 3").select("n_nationkey", "n_name")
    joined = enrich(enrich(t.orders, customer, ["o_custkey"]), nation, ["n_nationkey"])
    # Whole cents have exact sums, so both engines must find the very same mean.
    flagged = joined.select(
        "n_name", "o_custkey", (F.col("o_totalprice") >= F.col("c_acctbal") * 50).cast("int").alias("hit"),
        _cents("o_totalprice").alias("price"), _cents("c_acctbal").alias("balance"),
    )
    out = aggregate.group_summary(
        flagged, ["n_name"], {"o_custkey": "customers"},
        {"price": "avg_price_cents", "balance": "avg_balance_cents"}, {"hit": "pct_attained"},
    )
    return out.withColumn("pct_attained", F.round("pct_attained", 6))


@query("""
select event_type, count(*) as n, round(100.0 * count(*) / (select count(*) from events), 6) as pct
from events group by 1""")
def value_counts(t):
    return aggregate.value_counts(t.events, "event_type").withColumn("pct", F.round("pct", 6))


@query("""
with d as (select l_orderkey, l_linenumber, l_quantity, cast(l_returnflag = 'R' as int) as y from lineitem)
select count(*) as n_rows, 4 as n_columns,
  count(*) - (select count(*) from (select distinct * from d)) as duplicates,
  count(*) filter (y = 0) as negatives, count(*) filter (y = 1) as positives,
  round(100.0 * sum(y) / count(y), 2) as rate_pct
from d""")
def dataset_summary(t):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", (F.col("l_returnflag") == "R").cast("int").alias("y")
    )
    return aggregate.dataset_summary(rows, "y", {
        "rows": "n_rows", "columns": "n_columns", "duplicates": "duplicates", "negatives": "negatives",
        "positives": "positives", "rate_pct": "rate_pct",
    })


@query("""
select count(*) - (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem)) as duplicates
from lineitem""")
def duplicate_rows(t):
    return aggregate.duplicate_rows(t.lineitem.select("l_orderkey", "l_linenumber"))


@query("""
select lang, count(toxic) as n, round(avg(toxic), 8) as rate, round(100 * avg(toxic), 6) as rate_pct
from documents left join labels using (doc_id) group by 1 having count(toxic) >= 10""")
def rate_by_category(t):
    joined = enrich(t.documents.select("doc_id", "lang"), t.labels, ["doc_id"])
    rated = aggregate.rate_by_category(joined, "lang", "toxic", minimum=10)
    return rated.withColumns({"rate": F.round("rate", 8), "rate_pct": F.round("rate_pct", 6)})


def _labelled(t):
    return enrich(t.documents.select("doc_id", "lang", "source", "n_chars"), t.labels, ["doc_id"])


LABELLED = "select doc_id, lang, source, n_chars, quality, toxic from documents left join labels using (doc_id)"
LABELLED_COLUMNS = ("doc_id", "lang", "source", "n_chars", "quality", "toxic")


def _profile_sql(condition: str = "true") -> str:
    parts = " union all ".join(
        f"select '{c}' as \"column\", count(*) - count({c}) as nulls, "
        f"round(100.0 * (count(*) - count({c})) / count(*), 6) as null_pct, count(distinct {c}) as n_distinct from d"
        for c in LABELLED_COLUMNS
    )
    return f"with d as ({LABELLED}) select * from ({parts}) where {condition}"


@query(_profile_sql())
def column_profile(t):
    return profile.column_profile(_labelled(t)).drop("type")


@query(_profile_sql("null_pct > 20"))
def high_null(t):
    return profile.high_null(profile.column_profile(_labelled(t)).drop("type"))


@query("""
with d as (select min(o_orderstatus) = max(o_orderstatus) as a, min(o_custkey) = max(o_custkey) as b,
  true as c, count(distinct round(o_totalprice * 0)) <= 1 as d from orders)
select unnest(['o_orderstatus', 'o_custkey', 'year', 'zero']) as "column", unnest([a, b, c, d]) as constant from d""")
def constant_columns(t):
    rows = t.orders.select(
        "o_orderstatus", "o_custkey", F.lit(2024).alias("year"), F.round(F.col("o_totalprice") * 0).alias("zero")
    )
    found = constants(rows, rows.columns)
    return t.spark.createDataFrame([(c, c in found) for c in rows.columns], "column string, constant boolean")


DESCRIBED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(" union all ".join(
    f"select '{c}' as \"column\", count({c}) as n_known, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std, "
    f"min({c}) as min, max({c}) as max from lineitem" for c in DESCRIBED))
def describe_table(t):
    out = profile.describe(t.lineitem, DESCRIBED)
    return out.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})


CORRELATED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")


@query("with d as (select *, cast(l_returnflag = 'R' as int) as y from lineitem) " + " union all ".join(
    f"select '{c}' as \"column\", round(corr({c}, y), 6) + 0.0 as correlation, round(abs(corr({c}, y)), 6) as abs_correlation from d"
    for c in CORRELATED))
def correlation_rank(t):
    rows = t.lineitem.withColumn("y", (F.col("l_returnflag") == "R").cast("int")).withColumn("same", F.lit(1))
    ranked = profile.correlation_ranking(rows, [*CORRELATED, "same"], "y")
    return ranked.select(
        "column", (F.round("correlation", 6) + F.lit(0.0)).alias("correlation"),
        F.round("abs_correlation", 6).alias("abs_correlation"),
    ).orderBy(F.col("abs_correlation").desc_nulls_last())


QUALITY_COLUMNS = ("l_returnflag", "l_linenumber", "l_quantity", "l_discount")


@query("""
with raw as (select l_returnflag, l_linenumber, l_quantity, l_discount from lineitem),
d as (select distinct * from raw),
r as (select 'duplicatas_removidas' as teste, '' as coluna, (select count(*) from raw) - count(*) as resultado from d """
+ "".join(f" union all select 'valores_nulos', '{c}', count(*) - count({c}) from d" for c in QUALITY_COLUMNS) + """
  union all select 'faixa_0_100', 'l_quantity', count(*) filter (l_quantity < 0 or l_quantity > 40) from d
  union all select 'faixa_0_100', 'l_discount', count(*) filter (l_discount < 0 or l_discount > 100) from d
  union all select 'validacao_binaria_0_1', 'l_linenumber', count(*) filter (l_linenumber not in (0, 1)) from d
  union all select 'faixa_0_100', 'l_missing', 0)
select 'lineitem' as tabela, teste, coluna, resultado, case when teste = 'valores_nulos' then 'INFO'
  when resultado = 0 then 'OK' when teste = 'duplicatas_removidas' then 'AJUSTADO' else 'ERRO' end as status
from r""")
def quality_report(t):
    raw = t.lineitem.select(*QUALITY_COLUMNS)
    rules = [
        profile.in_range("l_quantity", 0, 40), profile.in_range("l_discount", 0, 100),
        profile.binary("l_linenumber"), profile.in_range("l_missing", 0, 100),
    ]
    return profile.quality_report(profile.distinct_rows(raw), "lineitem", rules, copies="_copies")


@query("""
select o_orderkey, (o_orderkey * 3)::double as mostly, case when o_orderkey % 4 = 0 then 'x' else o_orderkey::varchar end as mixed,
  o_orderkey::varchar as id_order from orders""")
def numeric_when_safe(t):
    """Texts that are numbers in nine of ten rows become numbers; identifiers and the others stay text."""
    number = F.col("o_orderkey")
    texts = t.orders.select(
        "o_orderkey", (number * 3).cast("string").alias("mostly"),
        F.when(number % 4 == 0, "x").otherwise(number.cast("string")).alias("mixed"), number.cast("string").alias("id_order"),
    )
    return profile.numeric_when_safe(texts)


def _wide_orders(t):
    customer = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_acctbal", "c_mktsegment")
    joined = enrich(t.orders, customer, ["o_custkey"])
    return joined.select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "c_acctbal", "c_mktsegment",
        F.lit(2024).alias("year"), (F.col("o_orderstatus") == "F").cast("int").alias("target"),
        F.col("o_totalprice").alias("leak_price"),
    )


FATES = {
    "o_orderkey": ("auditoria/grupo", "identifier"),
    "o_custkey": ("excluida", "other"),
    "o_totalprice": ("feature", "chosen"),
    "o_orderpriority": ("excluida", "free text"),
    "c_acctbal": ("feature", "chosen"),
    "c_mktsegment": ("feature", "chosen"),
    "year": ("excluida", "constant"),
    "target": ("target", "goal"),
}


@query("""
with d as (select o_orderkey, o_custkey, o_totalprice, o_orderpriority, c_acctbal, c_mktsegment, 2024 as year,
  cast(o_orderstatus = 'F' as int) as target from orders left join customer on o_custkey = c_custkey) """
+ " union all ".join(
    f"select '{c}' as coluna, '{s}' as status, '{m}' as motivo, count(*) - count({c}) as nulos, "
    f"round(100.0 * (count(*) - count({c})) / count(*), 2) as nulos_pct, count(distinct {c}) as unicos from d"
    for c, (s, m) in FATES.items()))
def feature_selection(t):
    safe, _ = drop_leakage(_wide_orders(t), ["leak_price", "leak_absent"])
    features = ["o_totalprice", "c_acctbal", "c_mktsegment", "year", "absent"]
    _, kept, constant = curate(safe, ["o_orderkey"], features, "target")
    texts = {"target": "goal", "audit": "identifier", "feature": "chosen", "constant": "constant", "other": "other"}
    report = profile.feature_report(
        safe, "target", ["o_orderkey"], kept, constant, {"o_orderpriority": "free text"}, texts
    )
    return report.drop("dtype_original")


@query("""
select o_orderkey, o_totalprice, c_acctbal, c_mktsegment, cast(o_orderstatus = 'F' as int) as target
from orders left join customer on o_custkey = c_custkey""")
def curated_matrix(t):
    safe, _ = drop_leakage(_wide_orders(t), ["leak_price"])
    numeric, categorical = numeric_and_categorical(safe, ["o_totalprice", "c_acctbal", "year", "c_mktsegment"])
    return curate(safe, ["o_orderkey"], [*numeric, *categorical, "absent"], "target")[0]


@query("""
select 'orders' as metrica, cast(count(*) as varchar) as valor from orders
union all select 'customers', cast(count(*) as varchar) from customer
union all select 'cutoff', '743'""")
def layer_summary(t):
    return aggregate.key_value_report({"orders": t.orders, "customers": t.customer}, {"cutoff": 743})


@query("""
with m as (select l_linenumber, l_returnflag, avg(l_quantity) as quantity, avg(l_discount) as discount
  from lineitem group by 1, 2)
select l_returnflag, round(avg(quantity), 6) as quantity_media, round(stddev_pop(quantity), 6) as quantity_std,
  round(avg(discount), 6) as discount_media, round(stddev_pop(discount), 6) as discount_std from m group by 1""")
def fold_statistics(t):
    measures = t.lineitem.groupBy("l_linenumber", "l_returnflag").agg(
        F.avg("l_quantity").alias("quantity"), F.avg("l_discount").alias("discount")
    )
    out = aggregate.mean_and_std(measures, ["l_returnflag"], ["quantity", "discount"])
    return out.select("l_returnflag", *[F.round(c, 6).alias(c) for c in out.columns[1:]])
