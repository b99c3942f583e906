"""Bronze, silver and gold jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.functions.indicators import attained, change, diverges, reaches
from lavra.functions.numbers import to_int, to_number
from lavra.functions.text import clean_text, normalize_code
from lavra.operators.aggregate import group_summary, key_value_report
from lavra.operators.columns import drop_prefixed, rename_existing, select_existing
from lavra.operators.profile import Rule, binary, in_range, quality_report
from lavra.operators.ranking import competition_rank, rank_in_group, sorted_by
from lavra.operators.reshape import melt_years
from lavra.operators.sampling import sample_with_counts
from lavra.plans import literacy as fixed
from lavra.sources.links import page_link_classes
from lavra.sources.sinks import append_manifest, write_layer


@dataclass(frozen=True)
class RawSource:
    """A table to take into the bronze layer, with where it came from."""

    name: str
    table: DataFrame
    url: str | None = None
    original: str | None = None
    tabular: str | None = None
    key: Sequence[str] | None = None


def bronze(
    spark: SparkSession, sources: Sequence[RawSource], folder: str, rows: int | None = None,
    seed: int = fixed.SEED,
) -> DataFrame:
    """Write every source, or with ``rows`` an exact sample of each, and the lineage manifest."""
    lineage = []
    for s in sources:
        if rows is None:
            kept = found = write_layer(s.table, f"{folder}/{s.name}")
        else:
            sample, found, _ = sample_with_counts(s.table, rows, s.key, seed)
            kept = write_layer(sample, f"{folder}/{s.name}")
        lineage.append((s.name, s.url, s.original, s.tabular, found, kept))
    append_manifest(spark, lineage, f"{folder}/_manifest")
    return spark.read.parquet(f"{folder}/_manifest")


@dataclass(frozen=True)
class SilverTable:
    """How a raw table becomes a typed one. Columns a table lacks are passed over."""

    name: str
    names: Mapping[str, str]
    texts: Sequence[str] = ()
    upper: Sequence[str] = ("sigla_uf",)
    codes: Mapping[str, int] = field(default_factory=dict)
    whole: Sequence[str] = ()
    numbers: Sequence[str] = ()
    rules: Sequence[Rule] = ()

    def typed(self, raw: DataFrame) -> DataFrame:
        df = select_existing(rename_existing(drop_prefixed(raw), self.names), self.names.values())
        there = set(df.columns)
        changed = {c: clean_text(F.col(c)) for c in self.texts if c in there}
        changed |= {c: F.upper(changed[c]) for c in self.upper if c in changed}
        changed |= {c: normalize_code(F.col(c), width) for c, width in self.codes.items() if c in there}
        changed |= {c: to_int(F.col(c)) for c in self.whole if c in there}
        changed |= {c: to_number(F.col(c)) for c in self.numbers if c in there}
        return df.withColumns(changed)


STUDENTS = SilverTable(
    "alunos", fixed.STUDENT_NAMES,
    texts=("sigla_uf", "id_aluno", "id_escola", "tipo_serie", "tipo_dependencia", "nome_municipio", "codigo_caderno_lp"),
    codes={"codigo_uf": 2, "codigo_municipio": 7},
    whole=("ano_avaliacao", "presenca_lp", "preenchimento_lp", "alfabetizado"),
    numbers=("peso_aluno_lp", "proficiencia_lp"),
    rules=tuple(binary(c) for c in ("presenca_lp", "preenchimento_lp", "alfabetizado")),
)
STATES = SilverTable(
    "ufs", fixed.STATE_NAMES, texts=("aba_origem", "sigla_uf", "nome_uf", "rede"), codes={"codigo_uf": 2},
    whole=("ano_avaliacao",), numbers=fixed.PERCENT_COLUMNS,
    rules=tuple(in_range(c, 0, 100) for c in fixed.PERCENT_COLUMNS),
)
MUNICIPALITIES = SilverTable(
    "municipios", fixed.MUNICIPALITY_NAMES,
    texts=("aba_origem", "sigla_uf", "nome_municipio", "rede", "nivel_alfabetizacao"),
    codes={"codigo_uf": 2, "codigo_municipio": 7},
    whole=("ano_avaliacao",), numbers=fixed.PERCENT_COLUMNS,
    rules=tuple(in_range(c, 0, 100) for c in fixed.PERCENT_COLUMNS),
)


def silver(raw: DataFrame, table: SilverTable, path: str) -> tuple[DataFrame, DataFrame]:
    """Write the typed, distinct table; return it and its quality report.

    The report reads the written table. Typing drops no row, so the rows before de-duplication are
    those of the bronze table, counted from its file footers.
    """
    write_layer(table.typed(raw).distinct(), path)
    written = raw.sparkSession.read.parquet(path)
    # A rule on a column the table lacks is only reported where the column is declared 0/1.
    rules = [r for r in table.rules if r.column in written.columns or r.allowed is not None]
    return written, quality_report(written, table.name, rules, raw.count())


def reject_bad_codes(df: DataFrame, column: str) -> DataFrame:
    """Drop rows such as repeated header lines, whose code held no digit but zeros."""
    return df.where(~F.col(column).rlike("^0*$") | F.col(column).isNull())


def _indicators(df: DataFrame) -> DataFrame:
    now, before, goal = (F.col(c) for c in ("pct_alfabetizados_2024", "pct_alfabetizados_2023", "meta_2024"))
    return df.withColumns({
        "variacao_2023_2024_pp": change(now, before),
        "gap_meta_2024_pp": change(now, goal),
        "atingiu_meta_2024": attained(now, goal),
    })


def gold_municipalities(silver_table: DataFrame) -> DataFrame:
    ranked = competition_rank(_indicators(silver_table), "pct_alfabetizados_2024", "ranking_amostra_brasil_2024")
    ranked = rank_in_group(ranked, ["sigla_uf"], "pct_alfabetizados_2024", "ranking_amostra_uf_2024")
    return select_existing(ranked, fixed.GOLD_MUNICIPALITIES)


def gold_states(silver_table: DataFrame) -> DataFrame:
    """State indicators; rows that are no state (the country, header lines) get no rank."""
    state = F.coalesce(F.length("sigla_uf") == 2, F.lit(False))
    ranked = competition_rank(_indicators(silver_table), "pct_alfabetizados_2024", "ranking_ufs_2024", where=state)
    return select_existing(ranked, fixed.GOLD_STATES)


def gold_students(silver_table: DataFrame, cutoff: float = fixed.CUTOFF) -> DataFrame:
    computed = reaches(F.col("proficiencia_lp"), cutoff)
    official = F.col("alfabetizado").cast("long")
    return select_existing(
        silver_table.withColumns({
            "alfabetizado_oficial": official,
            "alfabetizado_calculado_743": computed,
            "divergencia_indicador_743": diverges(official, computed),
        }),
        fixed.GOLD_STUDENTS,
    )


def gold_evolution(municipalities: DataFrame) -> DataFrame:
    long = melt_years(
        municipalities,
        ["codigo_uf", "sigla_uf", "codigo_municipio", "nome_municipio"],
        ["pct_alfabetizados_2023", "pct_alfabetizados_2024"],
        "pct_alfabetizados",
    )
    return sorted_by(long, ("codigo_municipio", False), ("ano", False))


def gold_state_summary(municipalities: DataFrame) -> DataFrame:
    summary = group_summary(
        municipalities,
        ["sigla_uf"],
        {"codigo_municipio": "municipios_na_amostra"},
        {
            "pct_alfabetizados_2023": "media_pct_alfabetizados_2023",
            "pct_alfabetizados_2024": "media_pct_alfabetizados_2024",
            "variacao_2023_2024_pp": "media_variacao_2023_2024_pp",
            "gap_meta_2024_pp": "media_gap_meta_2024_pp",
            "pct_participacao": "media_participacao",
        },
        {"atingiu_meta_2024": "pct_municipios_atingiram_meta_2024"},
    )
    return sorted_by(summary, ("sigla_uf", False))


def gold(silver_tables: Mapping[str, DataFrame], folder: str, sampled: bool = False) -> dict[str, DataFrame]:
    """Write all gold tables and the layer summary, which says so where the ranking is of a sample.

    The municipal table is written first; what builds on it reads the written copy.
    """
    spark = next(iter(silver_tables.values())).sparkSession

    def written(name: str, df: DataFrame) -> DataFrame:
        write_layer(df, f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    out = {"indicadores_municipios": written("indicadores_municipios", gold_municipalities(silver_tables["municipios"]))}
    out["indicadores_ufs"] = written("indicadores_ufs", gold_states(silver_tables["ufs"]))
    out["amostra_alunos"] = written("amostra_alunos", gold_students(silver_tables["alunos"]))
    out["evolucao_temporal_municipal"] = written(
        "evolucao_temporal_municipal", gold_evolution(out["indicadores_municipios"])
    )
    out["resumo_municipal_por_uf"] = written(
        "resumo_municipal_por_uf", gold_state_summary(out["indicadores_municipios"])
    )
    summary = key_value_report(
        {"municipios_gold": out["indicadores_municipios"], "alunos_gold": out["amostra_alunos"]},
        {"corte_proficiencia_alfabetizacao": fixed.CUTOFF} | ({"observacao_ranking_municipal": fixed.RANKING_NOTE} if sampled else {}),
    )
    out["_resumo"] = written("_resumo", summary)
    return out


def source_links(pages: DataFrame, fallback: Mapping[str, str], html: str = "html", url: str = "url") -> DataFrame:
    """The download links that stored pages name: a row per page and kind, with the fallback address where a page has none.

    ``fallback`` holds an address for each of the kinds in ``literacy.LINK_CLASSES`` that is wanted.
    """
    return page_link_classes(pages, html, url, fixed.LINK_CLASSES, dict(fallback), [url])


def run_layers(
    spark: SparkSession, raw: Mapping[str, DataFrame], folder: str, rows: int | None = None,
    keys: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, DataFrame]:
    """Bronze to gold for raw tables named ``alunos``, ``ufs`` and ``municipios``.

    ``rows`` samples each source, by the key given in ``keys`` where it has one.
    """
    sources = [RawSource(name, table, key=(keys or {}).get(name)) for name, table in raw.items()]
    bronze(spark, sources, f"{folder}/bronze", rows)
    tables, reports = {}, []
    for table in (STUDENTS, STATES, MUNICIPALITIES):
        source = spark.read.parquet(f"{folder}/bronze/{table.name}")
        tables[table.name], report = silver(source, table, f"{folder}/silver/{table.name}")
        reports.append(report)
    write_layer(reduce(lambda a, b: a.unionByName(b), reports), f"{folder}/silver/_relatorio_qualidade")
    return gold(tables, f"{folder}/gold", sampled=rows is not None)
