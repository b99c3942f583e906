import csv
import random

import pytest
from pyspark.sql import functions as F

from lavra.sources.files import largest_file, profile_files, schema_catalog
from lavra.sources.links import LinkClass, classify_links, links_with_fallback, page_link_classes, page_links, resolve_url
from lavra.sources.parts import union_parts
from lavra.sources.payloads import flatten_json, header_row_table
from lavra.session import staged
from lavra.sources import scan
from lavra.sources.scan import available, scan_quoted, scan_raw, scan_tolerant, scan_typed
from lavra.sources.sinks import append_manifest, external_manifest, write_json, write_layer
from lavra.streaming.chunks import ingest_new_files
from lavra.functions.text import clean_text


def test_scan_raw_is_all_text(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'\xef\xbb\xbfcode,name,n.x\n007,"a, ""b""",1\n012,NA,\n')
    df = scan_raw(spark, str(tmp_path / "a.csv"))
    assert df.dtypes == [("code", "string"), ("name", "string"), ("n.x", "string")]
    assert [tuple(r) for r in df.collect()] == [("007", 'a, "b"', "1"), ("012", None, None)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_raw(spark, str(tmp_path / "none.csv"))


def test_scan_windows_text(spark, tmp_path):
    (tmp_path / "w.csv").write_bytes("nome;preço\nJoão;5 €\n".encode("cp1252"))
    df = scan_raw(spark, str(tmp_path / "w.csv"), ";", "cp1252")
    assert df.columns == ["nome", "preço"] and tuple(df.first()) == ("João", "5 €")


def test_bad_lines(spark, tmp_path):
    (tmp_path / "b.csv").write_text('a;b;c\n1;2;3\n4;5\n6;7;8;9\n"x;y";z;w\n"p;q";r\n')
    df = scan_tolerant(spark, str(tmp_path / "b.csv"))
    rows = [("1", "2", "3"), ("4", "5", None), ("x;y", "z", "w"), ("p;q", "r", None)]
    assert [tuple(r) for r in df.collect()] == rows
    # Reading fewer columns must not change which lines are kept.
    assert [r["a"] for r in df.select("a").collect()] == [r[0] for r in rows]


def test_available_prunes_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    write_layer(spark.range(5).selectExpr("id", "id * 2 as b", "id * 3 as c"), path)
    df = available(scan_typed(spark, path), ["c", "x", "id", "c"])
    assert df.columns == ["c", "id"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,c:bigint>" in plan


def test_file_profiles(spark, tmp_path):
    (tmp_path / "u.csv").write_text("ção;b,c;d\n1;2;3\n")
    (tmp_path / "w.csv").write_bytes("a|b\nJoão|5 €\n".encode("cp1252"))
    (tmp_path / "l.csv").write_bytes(b"a\tb\n\xe9\t\x81\n")
    (tmp_path / "n.txt").write_text("only\nwords\nhere\n")
    got = {r["path"].rsplit("/", 1)[1]: tuple(r)[1:] for r in profile_files(spark, str(tmp_path)).collect()}
    assert got == {
        "u.csv": ("utf-8", ";", 2), "w.csv": ("cp1252", "|", 2), "l.csv": ("latin-1", "\t", 2), "n.txt": ("utf-8", ";", 3),
    }
    biggest = largest_file(spark, str(tmp_path)).first()
    assert biggest["path"].endswith("u.csv") and biggest["length"] == (tmp_path / "u.csv").stat().st_size


def test_catalog(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "k int, s string")
    rows = [tuple(r) for r in schema_catalog({"t": a, "_hidden": a}).collect()]
    assert rows == [("t", 1, "k", "int", 2, 0), ("t", 2, "s", "string", 2, 1)]


def test_union_parts(spark):
    one = spark.createDataFrame([("1", None, "x"), (None, None, None)], "a string, b string, c string")
    two = spark.createDataFrame([("2", "y")], "a string, d string")
    none = spark.createDataFrame([], "a string")
    df = union_parts({"um": one, "dois": two, "zero": none}, "_aba_origem")
    assert df.columns == ["_aba_origem", "a", "c", "d"]
    assert sorted(map(tuple, df.collect()), key=str) == [("dois", "2", None, "y"), ("um", "1", "x", None)]
    with pytest.raises(ValueError):
        union_parts({"zero": none})


@pytest.mark.parametrize("href, expected", [
    ("https://y.org/q", "https://y.org/q"), ("//y.org/q", "https://y.org/q"), ("/r/s?t=1", "https://x.org/r/s?t=1"),
    ("s.zip", "https://x.org/a/s.zip"), ("../s.zip", "https://x.org/s.zip"), ("../../../s", "https://x.org/s"),
    ("./s/./t/../u", "https://x.org/a/s/u"), ("#top", "https://x.org/a/b?c=1#top"), ("?d=2", "https://x.org/a/b?d=2"),
    ("mailto:a@b", "mailto:a@b"), ("", "https://x.org/a/b?c=1"), ("c/..", "https://x.org/a/"),
])
def test_resolve_url(spark, href, expected):
    df = spark.createDataFrame([("https://x.org/a/b?c=1", href)], "base string, href string")
    assert df.select(resolve_url(F.col("base"), F.col("href"))).first()[0] == expected


def test_links(spark):
    html = (
        "<script>'<a href=\"/no\">resultado meta uf</a>'</script><!-- <a href='/no'>microdados alfabet</a> -->"
        "<a class=x HREF='/one.xlsx'>Resultados e <b>Metas</b>\n UF</a><a href=two.xlsx>RESULTADO meta Brasil</a>"
        "<a name=q>resultado meta uf</a><a href=\"m.xlsx?a=1&amp;b=2\">Resultado Meta Munic&nbsp;UF</a>"
    )
    pages = spark.createDataFrame([(1, "https://g.br/p/q", html), (2, "https://g.br/z", None)], "id int, url string, html string")
    classes = (
        LinkClass("ufs", ("resultado", "meta"), ("uf", "brasil"), ("munic",)),
        LinkClass("mun", ("resultado", "meta", "munic")), LinkClass("micro", ("microdados", "alfabet")),
    )
    found = classify_links(page_links(pages, "html", "url", ["id"]), classes, ["id"])
    spare = {"ufs": "f1", "mun": "f2", "micro": "f3"}
    got = {(r["id"], r["link_class"]): (r["link"], r["found"]) for r in links_with_fallback(pages, found, spare, ["id"]).collect()}
    local = page_link_classes(pages, "html", "url", classes, spare, ["id"])
    assert got == {(r["id"], r["link_class"]): (r["link"], r["found"]) for r in local.collect()}
    assert "Exchange" not in local._jdf.queryExecution().toString()
    assert got == {
        (1, "ufs"): ("https://g.br/p/two.xlsx", True), (1, "mun"): ("https://g.br/p/m.xlsx?a=1&b=2", True),
        (1, "micro"): ("f3", False), (2, "ufs"): ("f1", False), (2, "mun"): ("f2", False), (2, "micro"): ("f3", False),
    }


def test_flatten_takes_whole_branch(spark):
    rows = [
        ('{"id": 1, "new-one": {"UF": {"sigla": "PE"}}, "old": {"UF": {"sigla": "XX", "nome": "Old"}}}',),
        ('{"id": 2, "new-one": {"UF": {}}, "old": {"UF": {"sigla": "BA", "nome": "Bahia"}}}',),
        ('{"id": 3, "old": {"UF": {"sigla": "CE", "nome": "Ceará"}}}',),
        ('{"id": 4}',),
    ]
    uf = "struct<UF: struct<sigla: string, nome: string>>"
    df = flatten_json(
        spark.createDataFrame(rows, "r string"), "r", f"struct<id: int, `new-one`: {uf}, old: {uf}>", {"id": "id"},
        {"sigla": "sigla", "nome": "nome"}, "`new-one`.UF", "old.UF",
    )
    assert [tuple(r) for r in df.orderBy("id").collect()] == [
        (1, "PE", None), (2, "BA", "Bahia"), (3, "CE", "Ceará"), (4, None, None)
    ]


def test_header_row(spark):
    payload = [{"D1C": "Município (Código)", "V": "Valor"}, {"D1C": "11", "V": "5"}, {"D1C": "12"}]
    df = spark.createDataFrame([(payload,)], "p array<map<string,string>>")
    out = header_row_table(df, "p")
    assert set(out.columns) == {"_ordinal", "Município (Código)", "Valor"}
    assert [tuple(r) for r in out.select("_ordinal", "`Município (Código)`", "Valor").collect()] == [(1, "11", "5"), (2, "12", None)]
    with pytest.raises(Exception, match="payload without data rows"):
        header_row_table(spark.createDataFrame([(payload[:1],)], "p array<map<string,string>>"), "p").collect()
    with pytest.raises(ValueError):
        header_row_table(df.limit(0), "p")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("ção", 1)], "s string, n int")
    assert write_layer(df, str(tmp_path / "a")) == 1
    assert write_layer(df.union(df), str(tmp_path / "a")) == 2
    assert write_layer(df, str(tmp_path / "c"), "csv") == 1
    write_json(df, str(tmp_path / "j"))
    assert any("ção" in p.read_text() for p in (tmp_path / "j").glob("*.json"))
    for _ in range(2):
        append_manifest(spark, [("x", None, None, None, 10, 5)], str(tmp_path / "m"))
    manifest = spark.read.parquet(str(tmp_path / "m"))
    assert manifest.count() == 2 and manifest.where("processado_em is not null").count() == 2
    external = external_manifest(spark, [("census", 2023, "f", "k", "use")]).first()
    assert external["ano"] == 2023 and len(external["processado_em"]) == 19


def test_chunks_take_each_file_once(spark, tmp_path):
    source, target, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    (tmp_path / "in").mkdir()

    def clean(df):
        return df.select(clean_text(F.col("a")).alias("a"))

    for i in range(3):
        (tmp_path / "in" / f"{i}.csv").write_text(f"a,b\n {i} ,x\nNULL,y\n")
        query = ingest_new_files(spark, source, "a string, b string", clean, target, progress, files_per_chunk=1)
        query.awaitTermination(60)
    assert sorted(r["a"] or "" for r in spark.read.parquet(target).collect()) == ["", "", "", "0", "1", "2"]


def test_quoted_breaks_across_splits(spark, tmp_path):
    rng = random.Random(3)
    folder = tmp_path / "quoted"
    folder.mkdir()
    for k in range(2):
        with open(folder / f"part{k}.csv", "w", newline="") as f:
            writer = csv.writer(f, lineterminator="\r\n" if k else "\n")
            writer.writerow(["id", "a note", "end"])
            for i in range(400):
                parts = [rng.choice(["x", "\n", '"', ",", "é", "\n\n", "words here"]) for _ in range(rng.randrange(1, 12))]
                writer.writerow([f"{k}-{i}", "n" + "".join(parts) + "z", "e"])
    whole = sorted(map(tuple, scan_raw(spark, str(folder), multi_line=True).collect()))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
        spark.conf.set("spark.sql.files.openCostInBytes", "0b")
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 16
        found = scan_quoted(spark, str(folder))
        assert found.columns == ["id", "a note", "end"]
        assert sorted(map(tuple, found.collect())) == whole and len(whole) == 800
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_quoted_lines_are_not_shuffled(spark, tmp_path, monkeypatch):
    """Records, one and the header longer than several splits; only counts by split and cut records are ordered."""
    folder = tmp_path / "long"
    folder.mkdir()
    for k in range(3):
        with open(folder / f"part{k}.csv", "w", newline="") as f:
            writer = csv.writer(f, lineterminator="\n")
            writer.writerow(["id", "head" + "\n of it" * 300])
            for i in range(60):
                writer.writerow([f"{k}-{i}", 'a "b"' + "\n,c" * (2000 if i % 20 == 7 else i % 3) + "z"])
    whole = sorted(map(tuple, scan_raw(spark, str(folder), multi_line=True).collect()))
    plans = []

    def told(df, name="stage"):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString().splitlines())
        return staged(df, name)

    monkeypatch.setattr(scan, "staged", told)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
        spark.conf.set("spark.sql.files.openCostInBytes", "0b")
        assert sorted(map(tuple, scan_quoted(spark, str(folder)).collect())) == whole and len(whole) == 180
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for plan in plans:
        for i in (i for i, line in enumerate(plan) if "Window [" in line):
            # Under a window, rows are added up before any text is read.
            assert next(x for x in plan[i + 1 :] if "Aggregate" in x or "Relation" in x).count("Aggregate") == 1
