"""Queries that clean, type and derive columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from lavra.functions.indicators import (
    attained, change, diverges, inverse_target, per_capita, reaches, share,
)
from lavra.functions.numbers import parse_numeric, to_int, to_number
from lavra.functions.text import clean_text, normalize_code, normalize_label
from lavra.operators.columns import drop_prefixed, rename_existing
from lavra.operators.joins import enrich
from lavra.operators.profile import coerce_numeric
from lavra.operators.reshape import first_of_category
from lavra.plans.registry import query
from lavra.sources.parts import union_parts

MESSY_CODE = """case c_custkey % 6
  when 0 then concat('  ', c_custkey, '.0 ') when 1 then concat('C-', c_custkey) when 2 then 'NULL'
  when 3 then ' ' when 4 then 'none' else cast(c_custkey as string) end"""


@query("""
with messy as (select c_custkey, case c_custkey % 6
  when 0 then concat('  ', c_custkey, '.0 ') when 1 then concat('C-', c_custkey) when 2 then 'NULL'
  when 3 then ' ' when 4 then 'none' else cast(c_custkey as varchar) end as raw from customer),
clean as (select c_custkey, nullif(nullif(nullif(nullif(trim(raw), ''), 'nan'), 'None'), 'NULL') as cleaned
  from messy),
digits as (select c_custkey, cleaned,
  regexp_replace(regexp_replace(cleaned, '\\.0$', ''), '[^0-9]', '', 'g') as d from clean)
select c_custkey, cleaned,
  case when length(d) < 7 then lpad(d, 7, '0') else d end as code7,
  case when length(d) < 2 then lpad(d, 2, '0') else d end as code2,
  case when d <> '' then case when length(d) < 7 then lpad(d, 7, '0') else d end end as code_or_null
from digits""")
def clean_codes(t):
    raw = t.customer.select("c_custkey", F.expr(MESSY_CODE).alias("raw"))
    return raw.select(
        "c_custkey",
        clean_text(F.col("raw")).alias("cleaned"),
        normalize_code(F.col("raw"), 7).alias("code7"),
        normalize_code(F.col("raw"), 2).alias("code2"),
        normalize_code(F.col("raw"), 7, empty_to_null=True).alias("code_or_null"),
    )


LOCAL_PRICE = """case o_orderkey % 6
  when 0 then replace(cast(cast(o_totalprice as decimal(12,2)) as string), '.', ',')
  when 1 then cast(cast(o_totalprice as decimal(12,2)) as string)
  when 2 then '-' when 3 then '...' when 4 then 'abc'
  else concat(cast(cast(floor(o_totalprice / 1000) as bigint) as string), '.',
    lpad(cast(cast(floor(o_totalprice) % 1000 as bigint) as string), 3, '0'), ',5') end"""


@query("""
with texts as (select o_orderkey, cast(o_custkey as varchar) || '.0' as whole, case o_orderkey % 6
  when 0 then replace(cast(cast(o_totalprice as decimal(12,2)) as varchar), '.', ',')
  when 1 then cast(cast(o_totalprice as decimal(12,2)) as varchar)
  when 2 then '-' when 3 then '...' when 4 then 'abc'
  else concat(cast(cast(floor(o_totalprice / 1000) as bigint) as varchar), '.',
    lpad(cast(cast(floor(o_totalprice) % 1000 as bigint) as varchar), 3, '0'), ',5') end as p from orders)
select o_orderkey,
  case when p like '%,%' then try_cast(replace(replace(p, '.', ''), ',', '.') as double)
    else try_cast(p as double) end as as_number,
  case when p = '-' then 0.0 when p = '...' then null
    else coalesce(try_cast(p as double), try_cast(replace(replace(p, '.', ''), ',', '.') as double)) end as as_numeric,
  cast(cast(whole as double) as bigint) as as_int
from texts""")
def parse_locale_numbers(t):
    texts = t.orders.select(
        "o_orderkey",
        F.expr(LOCAL_PRICE).alias("p"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(".0")).alias("whole"),
    )
    return texts.select(
        "o_orderkey",
        to_number(F.col("p")).alias("as_number"),
        parse_numeric(F.col("p")).alias("as_numeric"),
        to_int(F.col("whole")).alias("as_int"),
    )


@query("""
select p_partkey,
  case when p_partkey % 25 = 0 then null else cast(p_size as double) + 0.5 end as mostly_number,
  case when p_partkey % 5 = 0 then 'n/a' else cast(p_size as varchar) || ',5' end as often_number,
  cast(p_partkey as varchar) as id_part
from part""")
def coerce_columns(t):
    texts = t.part.select(
        "p_partkey",
        F.expr("case when p_partkey % 25 = 0 then 'n/a' else concat(p_size, ',5') end").alias("mostly_number"),
        F.expr("case when p_partkey % 5 = 0 then 'n/a' else concat(p_size, ',5') end").alias("often_number"),
        F.col("p_partkey").cast("string").alias("id_part"),
    )
    return coerce_numeric(texts, protected=["id_part"])


@query("""
select doc_id, upper(lang) as lang_code,
  trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', '_', 'g'), '_') as label
from documents""")
def normalize_labels(t):
    return t.documents.select(
        "doc_id", F.upper("lang").alias("lang_code"), normalize_label(F.col("text")).alias("label")
    )


@query("""
with j as (select o_orderkey, o_totalprice as price,
    case when c_acctbal >= 0 then c_acctbal * 50 end as goal,
    case o_orderstatus when 'F' then 1 when 'O' then 0 end as official
  from orders left join customer on o_custkey = c_custkey)
select o_orderkey, round(price - goal, 4) + 0.0 as gap,
  case when goal is not null and price is not null then cast(price >= goal as int) end as attained,
  cast(price >= 250000 as int) as over_cutoff,
  case when official is not null then cast(official <> cast(price >= 250000 as int) as int) end as divergent,
  1 - official as risk
from j""")
def target_flags(t):
    customer = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    joined = enrich(t.orders, customer, ["o_custkey"]).select(
        "o_orderkey",
        F.col("o_totalprice").alias("price"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") * 50).alias("goal"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0).alias("official"),
    )
    over = reaches(F.col("price"), 250000)
    return joined.select(
        "o_orderkey",
        (F.round(change(F.col("price"), F.col("goal")), 4) + F.lit(0.0)).alias("gap"),
        attained(F.col("price"), F.col("goal")).alias("attained"),
        over.alias("over_cutoff"),
        diverges(F.col("official"), over).alias("divergent"),
        inverse_target(F.col("official")).alias("risk"),
    )


@query("""
with s as (select o_custkey, o_orderstatus, cast(count(*) as double) as n, sum(o_totalprice) as amount
  from orders group by 1, 2),
w as (select o_custkey, max(case when o_orderstatus = 'F' then n end) as n_finished,
  max(case when o_orderstatus = 'O' then n end) as n_open,
  max(case when o_orderstatus = 'P' then amount end) as pending from s group by 1)
select o_custkey, n_finished, n_open, round(100 * n_finished / (n_finished + n_open), 6) as pct_finished,
  round(100 * n_open / (n_finished + n_open), 6) as pct_open,
  round(pending * 1000 / nullif(n_open, 0), 4) as pending_per_open
from w""")
def shares_per_capita(t):
    sums = t.orders.groupBy("o_custkey", "o_orderstatus").agg(
        F.count("*").cast("double").alias("n"), F.sum("o_totalprice").alias("amount")
    )
    # Both pivots share one aggregate.
    wide = sums.groupBy("o_custkey").agg(
        *first_of_category("o_orderstatus", "n", {"F": "n_finished", "O": "n_open"}, "o_orderstatus"),
        *first_of_category("o_orderstatus", "amount", {"P": "pending"}, "o_orderstatus"),
    )
    a, b = F.col("n_finished"), F.col("n_open")
    return wide.select(
        "o_custkey",
        a,
        b,
        F.round(share(a, b), 6).alias("pct_finished"),
        F.round(share(b, a), 6).alias("pct_open"),
        F.round(per_capita(F.col("pending"), b), 4).alias("pending_per_open"),
    )


@query("""
select 'finished' as _part, o_orderkey, o_totalprice, null as priority, null as o_custkey
from orders where o_orderstatus = 'F'
union all select 'open', o_orderkey, null, o_orderpriority, null from orders where o_orderstatus = 'O'
union all select 'pending', o_orderkey, o_totalprice, null, o_custkey from orders where o_orderstatus = 'P'""")
def multipart_union(t):
    o = t.orders
    nothing = F.lit(None).cast("string").alias("Unnamed: 3")
    parts = {
        "finished": o.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice", nothing),
        "open": o.where("o_orderstatus = 'O'").select("o_orderkey", "o_orderpriority", F.lit("x").alias("Unnamed: 3")),
        "pending": o.where("o_orderstatus = 'P'").select("o_orderkey", "o_totalprice", "o_custkey"),
        "empty": o.where("o_orderstatus is null"),
    }
    return rename_existing(drop_prefixed(union_parts(parts)), {"o_orderpriority": "priority", "absent": "x"})
