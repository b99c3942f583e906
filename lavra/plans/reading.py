"""Queries about sources and sinks. Files they read are first written from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lavra.operators.columns import find_column
from lavra.operators.sampling import sample_with_counts
from lavra.plans.registry import query
from lavra.session import scratch_path
from lavra.sources.files import largest_file as biggest, profile_files, scan_by_profile, schema_catalog as catalog
from lavra.sources.links import LinkClass, page_link_classes
from lavra.sources.payloads import flatten_json, header_row_table as labelled_rows, variant_fields
from lavra.sources.scan import available, scan_raw, scan_tolerant
from lavra.sources.sinks import append_manifest, write_layer

SAMPLED = {"customer": ["c_custkey"], "orders": ["o_orderkey"], "events": ["event_id"]}


@query(" union all ".join(
    f"select '{name}' as fonte, count(*) as linhas_origem, least(count(*), 5000) as linhas_bronze from {name}"
    for name in SAMPLED))
def raw_manifest(t):
    folder = scratch_path(t.spark, "bronze")
    rows = []
    for name, key in SAMPLED.items():
        sample, found, _ = sample_with_counts(getattr(t, name), 5000, key)
        path = f"{folder}/{name}"
        rows.append((name, None, f"{t.folder}/{name}.parquet", path, found, write_layer(sample, path)))
    append_manifest(t.spark, rows, f"{folder}/_manifest")
    return t.spark.read.parquet(f"{folder}/_manifest").select("fonte", "linhas_origem", "linhas_bronze")


@query("""
select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey from customer""")
def scan_text_table(t):
    path = scratch_path(t.spark, "text")
    write_layer(t.customer, path, "csv")
    return available(scan_raw(t.spark, path), ["c_custkey", "c_name", "c_absent", "c_nationkey"])


@query("""
select cast(o_orderkey as varchar) as a, case when o_orderkey % 10 <> 1 then o_orderstatus end as b,
  case when o_orderkey % 10 <> 1 then 'x;y' end as c from orders where o_orderkey % 10 <> 0""")
def scan_bad_lines(t):
    """Every tenth line has a field too many (skipped), every tenth one lacks fields (padded)."""
    path = scratch_path(t.spark, "lines")
    line = (
        F.when(F.col("o_orderkey") % 10 == 0, F.concat_ws(";", "o_orderkey", "o_orderstatus", F.lit("q;r;s")))
        .when(F.col("o_orderkey") % 10 == 1, F.col("o_orderkey").cast("string"))
        .otherwise(F.concat_ws(";", "o_orderkey", "o_orderstatus", F.lit('"x;y"')))
    )
    t.orders.select(line.alias("a;b;c")).write.options(header=True, quote="", sep="\t").csv(path)
    return scan_tolerant(t.spark, path)


def _exports(t) -> str:
    """The orders by status, each status as CSV with a delimiter of its own."""
    folder = scratch_path(t.spark, "exports")
    for status, sep in (("F", ";"), ("O", ","), ("P", "|")):
        rows = t.orders.where(F.col("o_orderstatus") == status).select("o_orderkey", "o_custkey", "o_orderpriority")
        rows.write.options(header=True, sep=sep).csv(f"{folder}/{status}.csv")
    return folder


@query("""
select o_orderstatus as name, 'utf-8' as encoding,
  case o_orderstatus when 'F' then ';' when 'O' then ',' else '|' end as separator, count(*) as n_records
from orders group by 1""")
def file_profile(t):
    folder = _exports(t)
    files = profile_files(t.spark, folder)
    name = F.regexp_extract("path", r"/([A-Z])\.csv/[^/]*$", 1)
    return files.groupBy(name.alias("name"), "encoding", "separator").agg(
        # Every part file has a header line of its own.
        F.sum(F.col("n_lines") - 1).alias("n_records")
    )


@query("""
select o_orderkey::varchar as o_orderkey, o_custkey::varchar as o_custkey, o_orderpriority from orders where o_orderstatus in ('F', 'O', 'P')""")
def folder_by_profile(t):
    """Files of different delimiters, each read by what its profile says, as one table."""
    return scan_by_profile(t.spark, _exports(t))


@query()
def largest_file(t):
    path = biggest(t.spark, _exports(t))
    return path.select(F.regexp_extract("path", r"/([A-Z])\.csv/[^/]*$", 1).alias("name"), "length")


CATALOGUED = {
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "labels": ("doc_id", "quality", "toxic"),
}


@query(" union all ".join(
    f"select '{t}' as table_name, {i + 1} as position, '{c}' as column_name, count(*) as n_rows, count(*) - count({c}) as n_nulls from {t}"
    for t, columns in CATALOGUED.items() for i, c in enumerate(columns)))
def schema_catalog(t):
    return catalog({name: getattr(t, name) for name in CATALOGUED} | {"_skipped": t.region}).drop("column_type")


LINK_CLASSES = (
    LinkClass("article", any_of=("the", "der", "la"), none_of=("anth",)),
    LinkClass("vowel", all_of=("e",), any_of=("a", "o")),
    LinkClass("both", all_of=("th", "e")),
)
LINK_SPARE = {
    "article": "https://example.org/article", "vowel": "https://example.org/vowel", "both": "https://example.org/both",
}


@query(r"""
with v as (select page_id, url, regexp_replace(html,
    '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', '', 'g') as h from pages),
a as (select page_id, url, unnest(regexp_extract_all(h, '(?is)<a\b[^>]*>.*?</a>')) as tag,
  generate_subscripts(regexp_extract_all(h, '(?is)<a\b[^>]*>.*?</a>'), 1) as pos from v),
l as (select page_id, pos, url, regexp_extract(tag, '(?is)^<a\b[^>]*\bhref\s*=\s*"([^"]*)"', 1) as href,
  lower(trim(regexp_replace(regexp_replace(tag, '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))) as txt
  from a where regexp_matches(tag, '(?is)^<a\b[^>]*\bhref\s*=\s*"')),
r as (select page_id, pos, txt, case when regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') then href
  when href like '/%' then regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1) || href
  when href like '#%' then url || href
  else regexp_replace(regexp_extract(url, '^([^?#]*)', 1), '[^/]*$', '') || href end as link from l),
c as (
  select page_id, pos, link, 'article' as link_class from r
    where (txt like '%the%' or txt like '%der%' or txt like '%la%') and txt not like '%anth%'
  union all select page_id, pos, link, 'vowel' from r where txt like '%e%' and (txt like '%a%' or txt like '%o%')
  union all select page_id, pos, link, 'both' from r where txt like '%th%' and txt like '%e%'),
m as (select page_id, link_class, max_by(link, pos) as link from c group by 1, 2),
w as (select page_id, k as link_class from pages, (select unnest(['article', 'vowel', 'both']) as k))
select page_id, link_class, coalesce(link, 'https://example.org/' || link_class) as link, link is not null as found
from w left join m using (page_id, link_class)""")
def page_links(t):
    return page_link_classes(t.pages, "html", "url", LINK_CLASSES, LINK_SPARE, ["page_id"])


@query("""
with e as (select event_id, user_id, cast(props ->> '$.k' as bigint) as k from events)
select event_id, k, case when user_id % 3 <> 0 then 'new' when user_id % 3 = 0 then 'old' end as place,
  user_id as place_id from e""")
def event_json(t):
    """Records that name their user in one of two places, as rebuilt from the event properties."""
    place = "named_struct('id', user_id, 'name', '{}')"
    record = F.expr(
        "to_json(named_struct('k', get_json_object(props, '$.k') + 0, "
        f"'new-place', named_struct('inner', if(user_id % 3 <> 0, {place.format('new')}, null)), "
        f"'old-place', named_struct('inner', {place.format('old')})))"
    )
    inner = "struct<inner: struct<id: bigint, name: string>>"
    return flatten_json(
        t.events.select("event_id", record.alias("record")), "record",
        f"struct<k: bigint, `new-place`: {inner}, `old-place`: {inner}>",
        plain={"k": "k"}, branch={"place": "name", "place_id": "id"},
        primary="`new-place`.inner", fallback="`old-place`.inner",
    )


@query("""
select o_orderkey as record, cast(o_custkey as varchar) as code, cast(o_orderstatus as varchar) as value from orders""")
def header_row_table(t):
    header = F.create_map(
        F.lit("D1C"), F.lit("Município (Código)"), F.lit("D1N"), F.lit("Município"), F.lit("V"), F.lit("Valor")
    )
    data = F.create_map(
        F.lit("D1C"), F.col("o_custkey").cast("string"), F.lit("V"), F.col("o_orderstatus")
    )
    payloads = t.orders.select(F.col("o_orderkey").alias("record"), F.array(header, data).alias("payload"))
    flat = labelled_rows(payloads, "payload")
    code = find_column(flat.columns, ["município", "código"])
    value = find_column(flat.columns, ["valor"])
    return flat.select("record", F.col(code).alias("code"), F.col(value).alias("value"))


@query("""
select event_id, case event_id % 4 when 2 then null when 3 then null else user_id::varchar end as id,
  case event_id % 4 when 0 then user_id when 1 then user_id end as number,
  case when event_id % 4 = 2 then user_id end as inner_id from events""")
def mixed_json(t):
    """Records that give their id as a number, as text, inside an object, or are no JSON at all."""
    user = F.col("user_id").cast("string")
    record = (
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit('{"id": '), user, F.lit("}")))
        .when(F.col("event_id") % 4 == 1, F.concat(F.lit('{"id": "'), user, F.lit('", "more": [1, "x"]}')))
        .when(F.col("event_id") % 4 == 2, F.concat(F.lit('{"place": {"id": '), user, F.lit("}}")))
        .otherwise(F.concat(F.lit("no json "), user))
    )
    fields = {"id": ("$.id", "string"), "number": ("$.id", "bigint"), "inner_id": ("$.place.id", "bigint")}
    return variant_fields(t.events.select("event_id", record.alias("r")), "r", fields)
