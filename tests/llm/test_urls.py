import random

import pytest
import xxhash

from lavra.llm import urls

RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
    ("com", "/de/", "block"), ("a.net", None, "block"), ("B.net", "/x", "allow"), ("b.net", "/x", "block"), ("a.net", "/é", "allow"),
    (None, "/", "block"), ("org", "/odd", "maybe"),
]
URLS = [
    "http://example.org/es/1", "https://www.EXAMPLE.org/en/12?q=/es/", "http://org", "http://org/", "http://x.com/fr/1#a", "http://x.com/de",
    "http://x.com/de/", "ftp://u@a.net:80/", "http://a.net", "http://s.a.net?x", "http://a.net/éa", "http://a.net/\u00e8", "http://b.net/xy",
    None, "", "no scheme", "x://", "://", "a://b://c/", "http://notexample.org/es/", "http://example.org/es/1", "http://é.org/es/",
]


def plain(url, rules=RULES, default="allow"):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = []
    for h, p, v in rules:
        if h is None or v not in urls.VERDICTS:
            continue
        h, p = h.lower(), p or ""
        if (host or path) and (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(h.encode()) + len(p.encode()), len(h.encode()), v, h + p))
    best = max(fits, default=None)
    return (host, path, best[3], best[2]) if best else (host, path, None, default)


@pytest.mark.parametrize("index_bytes", [urls.INDEX_BYTES, 0])
def test_verdicts(spark, index_bytes):
    pages = spark.createDataFrame([(i, u, "host?") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    found = urls.judge_urls(pages, rules, index_bytes=index_bytes)
    assert sorted(found.columns) == ["host", "page_id", "path", "rule", "url", "verdict"]
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found.collect()} == {i: plain(u) for i, u in enumerate(URLS)}
    assert urls.judge_urls(pages.limit(0), rules, index_bytes=index_bytes).count() == 0


def test_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a/")], "page_id long, url string")
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    assert urls.judge_urls(pages, rules, default="block").collect()[0].verdict == "block"


def test_stored_strings_settle_equal_digests(tmp_path, monkeypatch):
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda data, seed=0: len(data) % 3)
    rng = random.Random(1)
    names = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 7))) for _ in range(60)})
    known = names[::2]
    file = tmp_path / "index"
    file.write_bytes(urls.pack([(n, 0, rng.choice(urls.VERDICTS)) for n in known]))
    index = urls.Index(str(file))
    found = index.find([n.encode() for n in names])
    stored = [index.strings[int(index.ends[i]) : int(index.ends[i + 1])].tobytes().decode() if i >= 0 else None for i in found]
    assert stored == [n if n in known else None for n in names]
