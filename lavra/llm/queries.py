"""The registered query of each operator, over its whole table."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from lavra.llm import align, codes, decontaminate, lines, mixing, quality, scoring, setjoin, sharding, simhash, substrings, tokens, urls
from lavra.llm.registry import QUERIES, query, table
from lavra.session import staged

__all__ = ["QUERIES"]

# Vocabulary of op4_token_counts.
PIECES = os.environ.get("LAVRA_PIECES", "/opt/tokenizers/piece_bpe_32k.model")
# The tokenizers that op12_token_alignment lays side by side.
TOKENIZERS = (os.environ.get("LAVRA_BYTES", "/opt/tokenizers/byte_bpe_50k.json"), PIECES)


@query()
def op1_simhash_near_dedup(spark, folder):
    docs = table(spark, folder, "documents")
    found = simhash.near_duplicates(docs, carry=["doc_id"])
    return found.select("doc_id", simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


MIX_SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    ('0x' || substr(md5('mix|' || coalesce(doc_id::varchar, '\N') || '|' || coalesce(md5(text), '\N')), 1, 15))::bigint as k
  from documents),
s as (
  select source, source_size, [3, 1, 2][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w
  from (select source, sum(size)::bigint as source_size from d group by source)),
o as (
  select *, 2.0::double * source_size as lim, row_number() over (order by 2.0::double * source_size / w, source nulls last) as i from s),
l as (
  select i, (1.5::double * (select sum(source_size) from s) - coalesce(sum(lim) over (order by i rows between unbounded preceding and 1 preceding), 0))
    / sum(w) over (order by i rows between current row and unbounded following) as level, lim, w from o),
f as (select level from l where level * w < lim order by i limit 1),
t as (select source, source_size, least(lim, w * coalesce((select level from f), lim)) as target from o),
q as (
  select d.*, t.source_size, t.target, sum(size) over (partition by d.source order by k, size rows unbounded preceding)::bigint as sent
  from d join t on d.source is not distinct from t.source),
e as (
  select doc_id, source, k, size, turn, (sent + turn * source_size) / target as finish
  from q, (values (0), (1)) v(turn) where size > 0 and target > 0),
c as (
  select *, sum(size) over (order by finish, source nulls last, k, turn, size rows unbounded preceding) as total from e),
x as (
  select doc_id, source, k, size, sum(greatest(0, least(size, floor(1.5 * (select sum(size) from d))::bigint - (total - size))))::bigint as taken
  from c group by all)
select q.doc_id, q.size, q.source_size, q.target::double as target, coalesce(x.taken, 0)::bigint as taken
from q left join x on q.doc_id is not distinct from x.doc_id and q.source is not distinct from x.source and q.k = x.k
"""


@query(MIX_SQL)
def op2_weighted_mix(spark, folder):
    docs = table(spark, folder, "documents")
    return mixing.schedule(docs, carry=["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]

URL_SQL = r"""
with u as (
  select page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path from pages),
r(h, p, v) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
m as (
  select page_id, host, path, arg_max(h || p, length(h || p)) filter (where h is not null) as rule,
    arg_max(v, length(h || p)) filter (where h is not null) as v
  from u left join r on (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
  group by page_id, host, path)
select page_id, host, path, rule, coalesce(v, 'allow') as verdict from m
"""


@query(URL_SQL)
def op5_url_filter(spark, folder):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urls.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@query()
def op9_kd_shards(spark, folder):
    docs = table(spark, folder, "documents")
    found = sharding.numbered(docs, ["doc_id"], leaves=24)
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return found.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


LEAK_SQL = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
g as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as gram
  from (select item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i from b where len(w) > 0)),
p as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as gram
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from g)) where len(w) >= n),
h as (select doc_id, i, p.n, item_id from p join g on p.gram = g.gram and p.n = g.n),
k as (select doc_id, count(distinct x)::bigint as n_hit from (select doc_id, unnest(range(i, i + n)) as x from h) group by doc_id),
m as (
  select doc_id, count(*)::bigint as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256
  from (select distinct doc_id, item_id::varchar as item from h) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join k using (doc_id) left join m using (doc_id)
"""


@query(LEAK_SQL)
def op10_decontaminate(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


# Base metrics of the documents as a table b, and the certified cutoffs of each stratum as a table z.
QUALITY_WITH = r"""
w0 as (select doc_id, lang, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
g0 as (select doc_id, i, array_to_string(w[i:i + 4], ' ') as gram from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from w0 where len(w) >= 5)),
g1 as (select doc_id, i, count(*) over (partition by doc_id, gram) as n from g0),
g2 as (select doc_id, count(distinct x)::bigint as n from (select doc_id, unnest(range(i, i + 5)) as x from g1 where n > 1) group by doc_id),
l0 as (select doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from w0),
b as (
  select w0.doc_id, w0.lang, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(g2.n, 0)::bigint as n_repeat_words,
    len(w) < 10 or 100 * coalesce(g2.n, 0) > 20 * len(w) as base_failed
  from w0 join l0 using (doc_id) left join g2 using (doc_id)),
h as (select doc_id from labels where doc_id is not null and quality is not null group by doc_id having min(quality) = 1 and max(quality) = 1),
s as (
  select doc_id, lang, c.j, base_failed, n_symbols / n_words > c.symbols or n_repeat_words / n_words > c.repeats
    or 100.0::double * n_dup_lines / n_words > c.lines or word_chars / n_words > c.length as hit
  from b, (CUTS) c where n_words > 0),
t as (
  select lang, j, count(*) as n, count(*) filter (where hit) as k
  from (select doc_id, lang, j, bool_or(hit) as hit from s where not base_failed and doc_id in (from h) group by all) group by lang, j),
u as (
  select *, k < n * ALPHA and (select sum(exp(lgamma(n + 1) - lgamma(x + 1) - lgamma(n - x + 1) + x * ln(ALPHA) + (n - x) * ln(1 - ALPHA)))
      from range(0, k + 1) v(x)) <= DELTA / (select count(distinct coalesce(lang, chr(0))) from t) as ok from t),
z as (
  select lang, max(j) as j from (select *, bool_and(ok) over (partition by lang order by j) as sure from u) where sure group by lang)
"""
QUALITY_WITH = (
    QUALITY_WITH.replace("CUTS", " union all ".join(
        f"select {j} as j, " + ", ".join(f"{cuts[j]}::double as {r}" for r, (_, cuts) in quality.RULES.items()) for j in range(quality.STEPS)
    )).replace("ALPHA", f"{quality.ALPHA}::double").replace("DELTA", f"{quality.DELTA}::double")
)
QUALITY_SQL = f"""with {QUALITY_WITH}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not exists (
  select 1 from s join z on s.j = z.j and s.lang is not distinct from z.lang where s.doc_id = b.doc_id and s.hit) as kept
from b"""


@query(QUALITY_SQL)
def op3_quality_rules(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    measured = staged(quality.measure(docs).drop("text"), "metrics")
    steps = staged(quality.certify(measured, quality.labelled_keys(table(spark, folder, "labels"))), "steps")
    return quality.judge(measured, steps).select("doc_id", *quality.METRICS, "kept")


REPEATS_SQL = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
p as (select doc_id, len(w) as n, unnest(w) as x, generate_subscripts(w, 1) as i from d),
g as (select doc_id, n, i, concat_ws(' ', x, LEADS) as gram from p window o as (partition by doc_id order by i)),
m as (select doc_id, i, row_number() over (partition by gram order by doc_id, i) as place from g where i <= n - 19),
r as (select distinct doc_id, unnest(range(i, i + 20)) as i from m where place > 1),
k as (select doc_id, string_agg(x, ' ' order by i) as kept from p anti join r using (doc_id, i) group by doc_id),
n as (select doc_id, count(*) as n from r group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join k using (doc_id) left join n using (doc_id)
""".replace("LEADS", ", ".join(f"lead(x, {i}) over o" for i in range(1, 20)))


@query(REPEATS_SQL)
def op8_substring_dedup(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = substrings.remove_repeats(docs, carry=["doc_id"])
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op4_token_counts(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, tokens.piece_scores(PIECES)).select("doc_id", "n_words", "n_tokens")


LINES_SQL = r"""
with l as (
  select doc_id, x - 1 as line, list_distinct(regexp_extract_all(string_split(text, chr(10))[x], '[^\x20\x09-\x0D]+')) as w
  from (select doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) as x from documents where text is not null)),
u as (select row_number() over (order by doc_id, line) as i, w, n, count(*) over (partition by s) as copies, row_number() over (partition by s order by doc_id, line) as nth,
    doc_id, line from (select *, len(w) as n, list_sort(w) as s from l) where n > 0),
t as (select i, n, unnest(w) as word from u where nth = 1 and n >= 4),
f as (select word, count(*) as df from t group by word),
o as (select i, n, word, row_number() over (partition by i order by df, word) as k from t join f using (word)),
p as (select * from o where k <= n - (4 * n + 4) // 5 + 1),
c as (select distinct a.i as a, b.i as b, a.n as na, b.n as nb from p a join p b on a.word = b.word and a.i < b.i and 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
v as (select c.b from c join u x on x.i = c.a join u y on y.i = c.b group by c.a, c.b, x.w, y.w, na, nb
  having 9 * len(list_intersect(x.w, y.w)) >= 4 * (na + nb)),
r as (
  select doc_id, line from u where nth > 1 union
  select doc_id, line from u where i in (from v))
select d.doc_id, case when text is null then 0 else len(string_split(text, chr(10))) end::bigint as n_lines,
  (select count(*) from r where r.doc_id = d.doc_id)::bigint as n_removed,
  sha256(coalesce((select string_agg(line::varchar, ',' order by line) from r where r.doc_id = d.doc_id), '')) as removed_sha256
from documents d
"""


@query(LINES_SQL)
def op6_line_dedup(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = lines.mark_lines(docs, carry=["doc_id"])
    digest = F.sha2(F.array_join(F.col("removed").cast("array<string>"), ","), 256).alias("removed_sha256")
    return found.select("doc_id", "n_lines", "n_removed", digest)


@query()
def op7_lm_scoring(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = scoring.score(docs, scoring.fit(docs))
    return found.select("doc_id", "n_words", "log_likelihood", "mean_log_likelihood")


@query()
def op12_token_alignment(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return align.align(docs, *TOKENIZERS, carry=["doc_id"])[0]


def _codes_sql() -> str:
    """The rounds of op13_vector_codes written out, a pair of expressions each."""
    nearest = """
{d} as materialized (
  select rid, part, min(d * 256 + entry) as best from (
    select x.rid, x.part, b.entry, sum((x.val - b.val) * (x.val - b.val))::bigint as d
    from x join {b} b using (part, pos) group by all)
  group by all)"""
    means = """,
{b} as materialized (
  select o.part, o.entry, o.pos, coalesce(s.val, o.val) as val
  from {last} o left join (
    select x.part, d.best % 256 as entry, x.pos, floor(sum(x.val)::double / count(*))::bigint as val
    from x join {d} d using (rid, part) group by all) s using (part, entry, pos))"""
    rounds = ""
    for i in range(codes.ROUNDS):
        rounds += "," + nearest.format(d=f"d{i}", b=f"b{i}") + means.format(b=f"b{i + 1}", last=f"b{i}", d=f"d{i}")
    last = codes.ROUNDS
    return f"""
with v as materialized (
  select row_number() over (order by vec_id, embedding) as rid, vec_id, label,
    list_transform(embedding, lambda e: floor(e::double * 1024)::bigint) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0),
x as materialized (
  select rid, i // (n // 4) as part, i % (n // 4) as pos, v[i + 1] as val
  from (select rid, v, len(v) as n, unnest(range(len(v))) as i from v)),
b0 as materialized (select part, rid - 1 as entry, pos, val from x where rid <= 256){rounds},{nearest.format(d="f", b=f"b{last}")},
r as (
  select rid, string_agg(printf('%02x', best % 256), '' order by part) as code, sum(best // 256)::bigint as error
  from f group by rid)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
  sha256((select string_agg(val::varchar, ',' order by part, entry, pos) from b{last})) as codebooks_sha256
from v join r using (rid)
"""


@query(_codes_sql())
def op13_vector_codes(spark, folder):
    coded, books = codes.compress(table(spark, folder, "embeddings"), carry=["vec_id"])
    return coded.select("vec_id", "code", "error", "label_error", F.lit(codes.digest(books)).alias("codebooks_sha256"))


JACCARD_SQL = r"""
with recursive w as (
  select doc_id, row_number() over () as rid, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
s as materialized (
  select rid, doc_id, list_distinct(list_transform(range(1, case when len(w) = 0 then 1 else greatest(len(w) - 3, 2) end),
    lambda i: md5(array_to_string(w[i : i + 4], ' ')))) as s from w),
e as materialized (select rid, len(s) as n, unnest(s) as h from s),
c as materialized (
  select a, b from (
    select x.rid as a, y.rid as b, min(x.n) as na, min(y.n) as nb, count(*) as shared
    from e x join e y on x.h = y.h and x.rid < y.rid and 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n) group by 1, 2)
  where 100 * shared >= 80 * (na + nb - shared)),
l as materialized (select a, b from c union all select b, a from c),
t(rid, root) as (
  select rid, rid from s union select l.b, t.root from t join l on l.a = t.rid)
select s.doc_id, len(s.s)::bigint as n_shingles, min(o.doc_id) as component_id
from s join t using (rid) join s o on o.rid = t.root group by s.rid, s.doc_id, s.s
"""


@query(JACCARD_SQL)
def op11_jaccard_join(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return setjoin.jaccard_components(docs, carry=["doc_id"])
