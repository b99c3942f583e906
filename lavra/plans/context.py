"""External context per municipality: school census, localities, statistics tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.functions.indicators import category_flag, per_capita, share
from lavra.functions.numbers import parse_numeric, parse_plain
from lavra.functions.text import normalize_code, trim_all
from lavra.operators.aggregate import entity_rollup
from lavra.operators.columns import find_column, require_columns
from lavra.operators.joins import enrich_all, semi_filter
from lavra.operators.ranking import sorted_by
from lavra.operators.reshape import first_per_key, key_union, pivot_first
from lavra.plans import literacy as fixed
from lavra.session import staged
from lavra.sources.payloads import flatten_json, header_row_table
from lavra.sources.scan import available

KEY = "codigo_municipio"


def municipality_keys(*gold_tables: DataFrame) -> DataFrame:
    """Municipalities that occur in any gold table."""
    tables = [t for t in gold_tables if KEY in t.columns]
    if not tables:
        raise ValueError(f"no table with {KEY}")
    return key_union(tables, normalize_code(F.col(KEY).cast("string"), 7, empty_to_null=True), KEY)


def census_by_municipality(census: DataFrame, keys: DataFrame) -> DataFrame:
    """Schools rolled up to municipalities: counts, identity, percentages, means.

    The raw census is text. Only the columns used are read, only wanted municipalities are kept,
    and all measures come from one aggregate.
    """
    require_columns(census, ["CO_MUNICIPIO"], "school census")
    wanted = [
        "CO_MUNICIPIO", *fixed.CENSUS_IDENTITY, "TP_LOCALIZACAO", "TP_DEPENDENCIA",
        *fixed.CENSUS_FLAGS, *fixed.CENSUS_COUNTS,
    ]
    schools = available(census, wanted)
    schools = schools.withColumn(KEY, normalize_code(F.col("CO_MUNICIPIO"), 7, empty_to_null=True))
    schools = semi_filter(schools, keys, [KEY])
    there = set(schools.columns)
    measures = [c for c in (*fixed.CENSUS_FLAGS, *fixed.CENSUS_COUNTS) if c in there]
    typed = {c: parse_plain(trim_all(F.col(c))) for c in measures}
    percents = dict(fixed.CENSUS_FLAGS)
    for column, names in (("TP_LOCALIZACAO", fixed.CENSUS_PLACES), ("TP_DEPENDENCIA", fixed.CENSUS_OWNERS)):
        if column in there:
            code = parse_plain(trim_all(F.col(column)))
            typed |= {f"_{name}": category_flag(code, k) for name, k in names.items()}
            percents |= {f"_{name}": name for name in names}
    rolled = entity_rollup(
        schools.withColumns(typed), [KEY], "numero_escolas", fixed.CENSUS_IDENTITY, percents, fixed.CENSUS_COUNTS
    )
    return sorted_by(rolled, (KEY, False))


def localities(payload: DataFrame, column: str = "record") -> DataFrame:
    """Localities from JSON records, one per row; the state comes from either of two places."""
    flat = flatten_json(
        payload.select(column), column, fixed.LOCALITY_SCHEMA, fixed.LOCALITY_FIELDS, fixed.LOCALITY_STATE,
        primary="`regiao-imediata`.`regiao-intermediaria`.UF", fallback="microrregiao.mesorregiao.UF",
    )
    return flat.withColumns({
        KEY: normalize_code(F.col(KEY).cast("string"), 7, empty_to_null=True),
        "codigo_uf_ibge": normalize_code(F.col("codigo_uf_ibge").cast("string"), 2, empty_to_null=True),
    })


def _labelled(payload: DataFrame, column: str, *needed: tuple[list[str], list[str]]) -> tuple[DataFrame, list[str]]:
    rows = header_row_table(payload.select(column), column)
    found = [find_column(rows.columns, include, exclude=exclude) for include, exclude in needed]
    if None in found:
        raise KeyError(f"statistics table lacks one of {[include for include, _ in needed]}: {rows.columns}")
    return rows, found


def statistics_value(payload: DataFrame, name: str, column: str = "payload") -> DataFrame:
    """Municipality and value of a statistics table, the first row per municipality."""
    rows, (code, value) = _labelled(payload, column, (["município", "código"], []), (["valor"], []))
    picked = rows.select(
        "_ordinal",
        normalize_code(F.col(f"`{code}`"), 7, empty_to_null=True).alias(KEY),
        parse_numeric(F.col(f"`{value}`")).alias(name),
    )
    return first_per_key(picked.na.drop(subset=[KEY]), [KEY], ["_ordinal"]).drop("_ordinal")


def statistics_split(payload: DataFrame, column: str = "payload") -> DataFrame:
    """Urban, rural and total population per municipality with the shares of the first two."""
    rows, (code, value, category) = _labelled(
        payload, column, (["município", "código"], []), (["valor"], []), (["situação", "domicílio"], ["código"])
    )
    long = rows.select(
        "_ordinal",
        normalize_code(F.col(f"`{code}`"), 7, empty_to_null=True).alias(KEY),
        F.lower(trim_all(F.col(f"`{category}`"))).alias("categoria"),
        parse_numeric(F.col(f"`{value}`")).alias("valor"),
    ).na.drop(subset=[KEY])
    wide = pivot_first(long, [KEY], "categoria", "valor", fixed.POPULATION_SPLIT, "_ordinal")
    urban, rural = F.col("pop_urbana_2022"), F.col("pop_rural_2022")
    return wide.withColumns({"pct_urbana_2022": share(urban, rural), "pct_rural_2022": share(rural, urban)})


def territory(
    keys: DataFrame,
    places: DataFrame | None,
    population: DataFrame | None,
    split: DataFrame | None,
    product: DataFrame | None,
) -> DataFrame:
    """Localities with population, urban share and product per head. A failed source is ``None``."""
    base = keys.select(KEY) if places is None else first_per_key(semi_filter(places, keys, [KEY]), [KEY], [])
    none = f"{KEY} string, "
    population, split, product = (
        None if source is None else staged(source, "source") for source in (population, split, product)
    )
    joined = enrich_all(base, {
        "_pop": (population, none + "populacao_2022 double"),
        "_split": (split, none + "pop_urbana_2022 double, pop_rural_2022 double, "
                   "pop_total_urbano_rural_2022 double, pct_urbana_2022 double, pct_rural_2022 double"),
        "_pib": (product, none + "pib_2022_mil_reais double"),
    }, [KEY])
    rich = joined.withColumn(
        "pib_per_capita_2022", per_capita(F.col("pib_2022_mil_reais"), F.col("populacao_2022"))
    )
    return sorted_by(rich, (KEY, False))
