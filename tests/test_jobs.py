"""The named jobs end to end, on tables in the shapes they are meant for."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lavra.operators import models
from lavra.plans import context, jobs, layers, literacy, risk
from lavra.sources.sinks import load_run


@pytest.fixture(scope="module")
def raw(spark):
    rng = random.Random(8)
    states = ["PE", "BA", "AC"]
    students = []
    for i in range(240):
        s = rng.randrange(3)
        m = rng.randrange(12)
        score = rng.gauss(745 + 8 * s - 2 * m, 15)
        students.append((
            "2024", f"{26 + s}.0", f" {states[s].lower()} ", f"A{i}", "2", f"E{i % 60}", str(1 + m % 3), f"{2600000 + 100 * s + m}",
            f"City {m}", "1", "1", "7", "1,5" if i % 4 else "NULL", f"{score:.2f}".replace(".", ","), str(int(score >= 743)) if i % 40 else "",
        ))
    students.append(students[0])
    columns = ", ".join(f"`{c}` string" for c in literacy.STUDENT_NAMES)
    places = [
        ("s1", "2024", f"{26 + s}", states[s], f"{2600000 + 100 * s + m}", f"City {m}", "PÚBLICA",
         f"{40 + m},5" if m else None, f"{45 + 2 * (m % 5)},5", "50", *[str(51 + k) for k in range(6)], "N1", "88,1", "junk")
        for s in range(3) for m in range(12)
    ]
    place_columns = [*literacy.MUNICIPALITY_NAMES, "Unnamed: 9"]
    country = [
        ("s", None, "CO_UF", "SIGLA_UF", "NOME_UF", "REDE", *[None] * 10),
        ("s", "2024", None, None, "Brasil", "PÚBLICA", "55,9", "59,2", "59,9", *["60"] * 6, "87"),
        ("s", "2024", "12", "ac", "Acre", "PÚBLICA", None, "51,38", None, *["60"] * 6, "80"),
        ("s", "2024", "27", "AL", "Alagoas", "PÚBLICA", "43,88", "48,63", "49,7", *["60"] * 6, "101"),
    ]

    def text_table(rows, names):
        return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in names))

    return {
        "alunos": spark.createDataFrame(students, columns),
        "municipios": text_table(places, place_columns),
        "ufs": text_table(country, literacy.STATE_NAMES),
    }


@pytest.fixture(scope="module")
def gold(spark, raw, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("layers"))
    return layers.run_layers(spark, raw, folder), folder


def test_layers(spark, gold):
    tables, folder = gold
    manifest = spark.read.parquet(f"{folder}/bronze/_manifest")
    assert {r["fonte"]: (r["linhas_origem"], r["linhas_bronze"]) for r in manifest.collect()} == {
        "alunos": (241, 241), "municipios": (36, 36), "ufs": (4, 4)
    }
    quality = spark.read.parquet(f"{folder}/silver/_relatorio_qualidade")
    found = {(r["tabela"], r["teste"], r["coluna"]): (r["resultado"], r["status"]) for r in quality.collect()}
    assert found["alunos", "duplicatas_removidas", ""] == (1, "AJUSTADO")
    assert found["alunos", "valores_nulos", "peso_aluno_lp"] == (60, "INFO")
    assert found["ufs", "faixa_0_100", "pct_participacao"] == (1, "ERRO")
    assert found["municipios", "faixa_0_100", "meta_2024"] == (0, "OK")
    assert tables["amostra_alunos"].columns == list(literacy.GOLD_STUDENTS)
    assert tables["indicadores_municipios"].columns == list(literacy.GOLD_MUNICIPALITIES)
    assert tables["indicadores_ufs"].columns == list(literacy.GOLD_STATES)
    summary = {r["metrica"]: r["valor"] for r in tables["_resumo"].collect()}
    assert summary["municipios_gold"] == "36" and summary["corte_proficiencia_alfabetizacao"] == "743"


def test_source_links(spark):
    html = '<a href="/a">Resultado e Meta - Brasil e UF</a><a href="b.zip">Microdados Alfabetiza</a><a href="/c">Resultado, meta: Munic</a>'
    pages = spark.createDataFrame([("https://example.org/x/", html), ("https://example.org/y/", "<p>none</p>")], "url string, html string")
    spare = {"brasil_ufs": "https://spare/1", "municipios": "https://spare/2", "microdados": "https://spare/3"}
    got = {(r["url"][-2], r["link_class"]): (r["link"], r["found"]) for r in layers.source_links(pages, spare).collect()}
    assert got["x", "brasil_ufs"] == ("https://example.org/a", True) and got["x", "municipios"] == ("https://example.org/c", True)
    assert got["x", "microdados"] == ("https://example.org/x/b.zip", True)
    assert {v for k, v in got.items() if k[0] == "y"} == {(v, False) for v in spare.values()}


def test_state_indicators(gold):
    rows = {r["nome_uf"]: r for r in gold[0]["indicadores_ufs"].collect()}
    assert rows["NOME_UF"]["ranking_ufs_2024"] is None and rows["NOME_UF"]["codigo_uf"] == "00"
    assert rows["Brasil"]["ranking_ufs_2024"] is None and rows["Brasil"]["atingiu_meta_2024"] == 0
    assert rows["Acre"]["variacao_2023_2024_pp"] is None and rows["Acre"]["atingiu_meta_2024"] is None
    assert (rows["Acre"]["ranking_ufs_2024"], rows["Alagoas"]["ranking_ufs_2024"]) == (1, 2)
    assert rows["Alagoas"]["gap_meta_2024_pp"] == pytest.approx(-1.07)
    kept = layers.reject_bad_codes(gold[0]["indicadores_ufs"], "codigo_uf")
    assert {r["nome_uf"] for r in kept.collect()} == {"Brasil", "Acre", "Alagoas"}


def test_evolution_and_summary(gold):
    long = gold[0]["evolucao_temporal_municipal"]
    assert long.count() == 72 and set(long.columns) == {
        "codigo_uf", "sigla_uf", "codigo_municipio", "nome_municipio", "pct_alfabetizados", "ano"
    }
    summary = {r["sigla_uf"]: r for r in gold[0]["resumo_municipal_por_uf"].collect()}
    assert summary["PE"]["municipios_na_amostra"] == 12
    assert summary["PE"]["pct_municipios_atingiram_meta_2024"] == pytest.approx(100 * 4 / 12)
    tops = gold[0]["indicadores_municipios"].where("sigla_uf = 'PE' and ranking_amostra_uf_2024 = 1").count()
    assert tops == 2


@pytest.fixture(scope="module")
def outside(spark, gold):
    keys = context.municipality_keys(gold[0]["indicadores_municipios"], gold[0]["amostra_alunos"])
    rng = random.Random(2)
    schools = []
    for m in range(12):
        for s in range(3):
            for k in range(4):
                schools.append((f"{2600000 + 100 * s + m}", None if k else "X", "PE", "26", ["1", "2", None][k % 3], str(1 + k % 4),
                                ["1", "0", "", "x"][k], str(rng.randint(1, 20))))
    schools.append(("9999999", "Away", "ZZ", "99", "1", "1", "1", "5"))
    census = spark.createDataFrame(
        schools, "CO_MUNICIPIO string, NO_MUNICIPIO string, SG_UF string, CO_UF string, TP_LOCALIZACAO string, "
        "TP_DEPENDENCIA string, IN_INTERNET string, QT_SALAS_UTILIZADAS string",
    )
    return keys, context.census_by_municipality(census, keys)


def test_census(outside):
    keys, census = outside
    assert keys.count() == 36 and census.count() == 36
    row = census.where("codigo_municipio = '2600000'").first()
    assert row["numero_escolas"] == 4 and row["nome_municipio_censo"] == "X"
    # A missing place counts as "not urban", a missing flag does not count at all.
    assert row["pct_escolas_urbanas"] == 50.0 and row["pct_escolas_rurais"] == 25.0
    assert row["pct_escolas_internet"] == 50.0 and row["pct_escolas_federais"] == 25.0
    assert "media_salas_existentes" not in census.columns


def raw_localities(spark):
    uf = {"id": 26, "sigla": "PE", "nome": "Pernambuco", "regiao": {"id": 2, "sigla": "NE", "nome": "Nordeste"}}
    rows = []
    for s in range(3):
        for m in range(12):
            record = {"id": 2600000 + 100 * s + m, "nome": f"City {m}"}
            if m % 2:
                record["regiao-imediata"] = {"id": 1, "nome": "i", "regiao-intermediaria": {"id": 3, "nome": "t", "UF": uf}}
            else:
                record["microrregiao"] = {"id": 4, "nome": "mi", "mesorregiao": {"id": 5, "nome": "me", "UF": uf}}
            rows.append((json.dumps(record, ensure_ascii=False),))
    return spark.createDataFrame(rows, "record string")


def localities(spark):
    return context.localities(raw_localities(spark))


def statistics(spark, values, split=None):
    header = {"D1C": "Município (Código)", "D1N": "Município", "V": "Valor"}
    if split:
        header |= {"D2C": "Situação do domicílio (Código)", "D2N": "Situação do domicílio"}
    payload = [header]
    for k, v in values:
        payload += [{"D1C": k, "D1N": "n", "V": str(v), **({"D2C": c, "D2N": c} if split else {})} for c in (split or [""])]
    return spark.createDataFrame([(payload,)], "payload array<map<string,string>>")


@pytest.fixture(scope="module")
def territory(spark, outside):
    keys, _ = outside
    codes = [f"{2600000 + 100 * s + m}" for s in range(3) for m in range(12)]
    population = context.statistics_value(statistics(spark, [(c, "1.000,0") for c in codes] + [(codes[0], 5)]), "populacao_2022")
    split = context.statistics_split(statistics(spark, [(c, 3) for c in codes[1:]] + [(codes[0], "-")], ["Urbana", "Rural", "Total"]))
    return context.territory(keys, localities(spark), population, split, None), population, split


def test_territory(territory):
    table, population, split = territory
    assert population.count() == 36 and population.where("populacao_2022 <> 1000").count() == 0
    assert split.where("codigo_municipio = '2600000'").first()["pct_urbana_2022"] is None
    assert split.where("codigo_municipio = '2600001'").first()["pct_urbana_2022"] == 50.0
    assert table.count() == 36 and table.where("pib_2022_mil_reais is not null").count() == 0
    assert table.where("sigla_uf_ibge = 'PE' and sigla_regiao = 'NE'").count() == 36
    with pytest.raises(KeyError):
        context.statistics_split(statistics(table.sparkSession, [("1", 1)]))


def test_modelling(spark, gold, outside, territory, tmp_path):
    students = gold[0]["amostra_alunos"]
    made = risk.modelling_table(students, gold[0]["indicadores_municipios"], outside[1], territory[0])
    known = students.where("alfabetizado_oficial in (0, 1)").count()
    assert made.data.count() == known == made.summary.first()["linhas"]
    assert made.summary.first()["leakage_removido"] == "proficiencia_lp;alfabetizado_calculado_743;divergencia_indicador_743"
    assert [r["coverage_pct"] for r in made.coverage.collect()] == [100.0, 100.0]
    table, kept, report = risk.curated(made.data)
    fates = {r["coluna"]: r["status"] for r in report.collect()}
    assert fates[literacy.TARGET] == "target" and fates["id_escola"] == "auditoria/grupo"
    assert fates["ano_avaliacao"] == "excluida" and fates["meta_2024"] == "excluida" and "sigla_uf" in kept
    looks = risk.exploration(made.data)
    assert looks["resumo_geral"].first()["linhas"] == known
    assert looks["correlacoes_target"].first()["column"] == "alfabetizado_oficial"
    assert looks["correlacoes_target"].first()["correlation"] == pytest.approx(-1)
    assert looks["risco_por_uf"].count() == 3 and looks["distribuicao_target"].count() == 2

    run = risk.train(table, kept, [models.LOGISTIC], draws=2)
    assert run.best == "logistic_regression" and run.metrics.count() == 1
    assert run.train.select("id_escola").intersect(run.test.select("id_escola")).count() == 0
    assert run.metadata.first()["train_rows"] + run.metadata.first()["test_rows"] == known
    explained = risk.explain_run(run, repeats=2)
    assert explained["permutation_importance"].count() == len(run.fitted.numeric + run.fitted.categorical)
    assert {r["feature_original"] for r in explained["shap_importance"].collect()} <= set(kept)
    everyone, ranked = risk.risk_by_municipality(run.predictions, minimum=2)
    assert everyone.agg(F.sum("alunos_teste")).first()[0] == run.predictions.count()
    places = [(r["ranking_risco_amostra"], r["risco_medio"]) for r in ranked.collect()]
    assert [p for p, _ in places] == list(range(1, len(places) + 1))
    assert [v for _, v in places] == sorted((v for _, v in places), reverse=True)
    comparison, verdict, predictions = risk.without_feature(run)
    assert comparison.count() == 7 and verdict.count() == 1 and predictions.count() == run.predictions.count()
    with pytest.raises(ValueError):
        risk.without_feature(run, "gone")


def census(spark):
    return spark.createDataFrame([("2600000", "X", "PE", "26", "1", "2", "1", "5")], "CO_MUNICIPIO string, NO_MUNICIPIO string, "
                                 "SG_UF string, CO_UF string, TP_LOCALIZACAO string, TP_DEPENDENCIA string, IN_INTERNET string, QT_SALAS_UTILIZADAS string")


def test_halves_fail_alone(spark, outside, tmp_path):
    keys, _ = outside
    codes = [f"{2600000 + 100 * s + m}" for s in range(3) for m in range(12)]
    facts = {"censo": ("Censo", 2023, "schools"), "ibge": ("IBGE", 2022, "territory")}

    def broken():
        raise OSError("no answer")

    sources = {"localities": lambda: raw_localities(spark), "population": lambda: statistics(spark, [(c, "1.000,0") for c in codes]), "product": broken}
    out = jobs.run_context(spark, str(tmp_path / "a"), keys, broken, sources, facts)
    assert set(out.tables) == {"ibge"} and set(out.failures) == {"censo", "product"}
    table = out.tables["ibge"]
    assert table.count() == 36 and table.where("populacao_2022 = 1000 and pib_2022_mil_reais is null and pop_urbana_2022 is null").count() == 36
    told = {r["fonte"]: r for r in spark.read.parquet(str(tmp_path / "a" / "_manifest")).collect()}
    assert told["Censo"]["arquivo"] == "" and told["IBGE"]["arquivo"].endswith("/ibge")
    assert (told["IBGE"]["ano"], told["IBGE"]["chave_integracao"]) == (2022, "codigo_municipio")
    out = jobs.run_context(spark, str(tmp_path / "b"), keys, lambda: census(spark), {"product": broken}, facts)
    assert set(out.tables) == {"censo"} and set(out.failures) == {"ibge", "product"}
    assert {r["fonte"]: bool(r["arquivo"]) for r in spark.read.parquet(str(tmp_path / "b" / "_manifest")).collect()} == {"Censo": True, "IBGE": False}
    out = jobs.run_context(spark, str(tmp_path / "c"), keys, broken, {}, facts)
    assert not out.tables and spark.read.parquet(str(tmp_path / "c" / "_manifest")).where("arquivo = ''").count() == 2


def test_risk_in_one_call(spark, gold, outside, territory, tmp_path):
    made = risk.modelling_table(gold[0]["amostra_alunos"], gold[0]["indicadores_municipios"], outside[1], territory[0])
    table, kept, _ = risk.curated(made.data)
    small = [models.ModelSpec("random_forest", params={"n_estimators": 3, "max_depth": 4})]
    run, reports = jobs.run_risk(str(tmp_path / "risk"), table, kept, small, draws=1, repeats=1, minimum=2)
    model, predictions, facts = load_run(spark, str(tmp_path / "risk" / "run"))
    assert predictions.count() == run.test.count() and facts.first()["best_model"] == "random_forest" and facts.first()["positive_class"] == "1"
    summary = reports["robustez_resumo"].first()
    assert (summary["modelo_original"], summary["feature_removida"]) == ("random_forest", "sigla_uf")
    assert summary["features_restantes"] == len(run.fitted.numeric + run.fitted.categorical) - 1 and summary["interpretacao"]
    assert reports["shap_importance"].count() > 0 and reports["ranking_municipios"].count() > 0
    assert {r["feature_original"] for r in reports["shap_importance_transformed"].collect()} <= set(kept)
