"""Links out of stored web pages, classified by the words of their anchor text."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ANCHOR = r"(?is)<a\b([^>]*)>(.*?)</a>"
HIDDEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
HREF = r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""

# The entities that occur in links and anchor texts.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


@dataclass(frozen=True)
class LinkClass:
    """A class of links: all of these words, at least one of those, none of the last ones."""

    name: str
    all_of: Sequence[str] = ()
    any_of: Sequence[str] = ()
    none_of: Sequence[str] = ()

    def matches(self, text: Column) -> Column:
        hit = F.lit(True)
        for word in self.all_of:
            hit = hit & F.contains(text, F.lit(word))
        if self.any_of:
            some = F.lit(False)
            for word in self.any_of:
                some = some | F.contains(text, F.lit(word))
            hit = hit & some
        for word in self.none_of:
            hit = hit & ~F.contains(text, F.lit(word))
        return hit


def unescape(c: Column) -> Column:
    for entity, char in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def _without_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` steps of an absolute path."""
    steps = F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda done, step: F.when(
            step == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))
        )
        .when(step == ".", done)
        .otherwise(F.array_append(done, step)),
    )
    tail = F.when(path.rlike(r"/\.{1,2}$"), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.concat_ws("/", steps), tail)


def resolve_url(base: Column, href: Column) -> Column:
    """The absolute form of a link found on page ``base``."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    whole = F.regexp_extract(base, r"^([^#]*)", 1)
    page_path = F.regexp_replace(page, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    folder = F.when(page_path == "", F.lit("/")).otherwise(F.regexp_replace(page_path, "[^/]*$", ""))
    link_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    link_rest = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    return (
        F.when(href == "", base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(site, _without_dots(link_path), link_rest))
        .when(href.startswith("#"), F.concat(whole, href))
        .when(href.startswith("?"), F.concat(page, href))
        .otherwise(F.concat(site, _without_dots(F.concat(folder, link_path)), link_rest))
    )


def _anchors(html: Column) -> Column:
    """Attributes and body of the anchors of a page that have a target, in order."""
    visible = F.regexp_replace(html, HIDDEN, "")
    found = F.arrays_zip(
        F.regexp_extract_all(visible, F.lit(ANCHOR), F.lit(1)).alias("attrs"),
        F.regexp_extract_all(visible, F.lit(ANCHOR), F.lit(2)).alias("body"),
    )
    return F.filter(found, lambda a: a["attrs"].rlike(HREF))


def _target(base: Column, attrs: Column) -> Column:
    href = F.concat(*[F.regexp_extract(attrs, HREF, i) for i in (1, 2, 3)])
    return resolve_url(base, F.trim(unescape(href)))


def _label(body: Column) -> Column:
    text = unescape(F.regexp_replace(body, r"(?s)<[^>]*>", " "))
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def page_links(pages: DataFrame, html: str, url: str, keep: Sequence[str]) -> DataFrame:
    """One row per anchor with a target: page columns, position, absolute link, lower-case text."""
    # The page itself is not carried through the generator: only its key and address are.
    rows = pages.select(*keep, F.col(url).alias("_base"), F.posexplode(_anchors(F.col(html))).alias("pos", "a"))
    return rows.select(
        *keep, "pos", _target(F.col("_base"), F.col("a.attrs")).alias("link"), _label(F.col("a.body")).alias("link_text")
    )


def page_link_classes(
    pages: DataFrame, html: str, url: str, classes: Sequence[LinkClass], fallback: dict[str, str], keep: Sequence[str]
) -> DataFrame:
    """Every page with every class: its last matching link, or the fallback address, and whether it was found.

    The anchors of a page are judged in its own row, so nothing is shuffled.
    """
    labelled = F.transform(_anchors(F.col(html)), lambda a: F.struct(a["attrs"].alias("attrs"), _label(a["body"]).alias("text")))
    rows = pages.select(*keep, F.col(url).alias("_base"), labelled.alias("_links"))

    def last(k: LinkClass) -> Column:
        hits = F.filter("_links", lambda a: k.matches(a["text"]))
        return F.try_element_at(hits, F.lit(-1))["attrs"]

    known = {k.name: k for k in classes}
    every = [
        F.struct(
            F.lit(name).alias("link_class"), F.lit(spare).alias("spare"),
            (last(known[name]) if name in known else F.lit(None).cast("string")).alias("attrs"),
        )
        for name, spare in fallback.items()
    ]
    each = rows.select(*keep, "_base", F.explode(F.array(*every)).alias("w")).select(*keep, "_base", "w.*")
    # Only the links that are returned are resolved.
    link = F.when(F.col("attrs").isNotNull(), _target(F.col("_base"), F.col("attrs")))
    resolved = each.withColumn("_link", link)
    return resolved.select(
        *keep, "link_class", F.coalesce("_link", "spare").alias("link"), F.col("_link").isNotNull().alias("found")
    )


def classify_links(links: DataFrame, classes: Sequence[LinkClass], keep: Sequence[str]) -> DataFrame:
    """The last matching link of every class on a page. A link may belong to several classes."""
    text = F.col("link_text")
    hits = F.array_compact(F.array(*[F.when(k.matches(text), F.lit(k.name)) for k in classes]))
    return (
        links.select(*keep, "pos", "link", F.explode(hits).alias("link_class"))
        .groupBy(*keep, "link_class")
        .agg(F.max_by("link", "pos").alias("link"))
    )


def links_with_fallback(
    pages: DataFrame, found: DataFrame, fallback: dict[str, str], keep: Sequence[str]
) -> DataFrame:
    """Every page with every class; classes not found on a page get the fallback address."""
    wanted = F.explode(
        F.array(*[F.struct(F.lit(k).alias("link_class"), F.lit(v).alias("spare")) for k, v in fallback.items()])
    )
    return (
        pages.select(*keep, wanted.alias("w"))
        .select(*keep, "w.*")
        .join(found, [*keep, "link_class"], "left")
        .select(
            *keep,
            "link_class",
            F.coalesce("link", "spare").alias("link"),
            F.col("link").isNotNull().alias("found"),
        )
    )
