"""Whole jobs as one call: external context whose sources may fail alone, and modelling from table to reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target

from lavra.operators import models
from lavra.plans import context, risk
from lavra.plans import literacy as fixed
from lavra.sources.sinks import external_manifest, save_run, write_json

Source = Callable[[], DataFrame]


@dataclass
class Outcome:
    """What parts of a job made, and the error of each part that failed."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    failures: dict[str, Exception] = field(default_factory=dict)


def run_parts(spark: SparkSession, parts: Mapping[str, Source]) -> Outcome:
    """Run independent parts at once; one that fails leaves the others alone.

    A part returns a table that it has computed or written: what fails later fails whoever reads it.
    """
    def run(item: tuple[str, Source]) -> tuple[str, DataFrame | None, Exception | None]:
        try:
            return item[0], item[1](), None
        except Exception as e:  # noqa: BLE001
            return item[0], None, e

    out = Outcome()
    with ThreadPool(max(1, len(parts))) as pool:
        for name, table, error in pool.map(inheritable_thread_target(spark)(run), list(parts.items())):
            if error is None:
                out.tables[name] = table
            else:
                out.failures[name] = error
    return out


def run_context(
    spark: SparkSession, folder: str, keys: DataFrame, census: Source, statistics: Mapping[str, Source], facts: Mapping[str, tuple],
) -> Outcome:
    """The two halves of the external context, written to ``folder``; and a manifest in any case: a half that failed has no file there.

    ``census`` gives the raw school census. ``statistics`` gives raw payloads named ``localities``,
    ``population``, ``split`` and ``product``; each may be left out or fail alone, and its columns are then null. ``facts`` has
    (source, year, use) of the halves ``censo`` and ``ibge`` for the manifest. Failures are returned, not raised.
    """
    readers = {
        "localities": context.localities,
        "population": lambda raw: context.statistics_value(raw, "populacao_2022"),
        "split": context.statistics_split,
        "product": lambda raw: context.statistics_value(raw, "pib_2022_mil_reais"),
    }

    def written(name: str, table: DataFrame) -> DataFrame:
        table.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    def census_half() -> DataFrame:
        return written("censo", context.census_by_municipality(census(), keys))

    sources: dict[str, Exception] = {}

    def territory_half() -> DataFrame:
        read = run_parts(spark, {
            n: (lambda n=n: written(f"_{n}", readers[n](statistics[n]()))) for n in readers if n in statistics
        })
        sources.update(read.failures)
        if not read.tables:
            raise RuntimeError(f"no statistics source could be read: {sorted(read.failures)}")
        found = (read.tables.get(n) for n in ("localities", "population", "split", "product"))
        return written("ibge", context.territory(keys, *found))

    out = run_parts(spark, {"censo": census_half, "ibge": territory_half})
    out.failures |= sources
    rows = [
        (source, year, f"{folder}/{name}" if name in out.tables else "", context.KEY, use) for name, (source, year, use) in facts.items()
    ]
    external_manifest(spark, rows).write.mode("overwrite").parquet(f"{folder}/_manifest")
    return out


def run_risk(
    folder: str, data: DataFrame, features: Sequence[str], specs: Sequence[models.ModelSpec] = models.MODELS,
    draws: int = 10, repeats: int = 10, minimum: int = fixed.RANKING_MINIMUM, without: str | None = "sigla_uf",
) -> tuple[risk.Training, dict[str, DataFrame]]:
    """Train, judge, explain and rank; write the model, its predictions and metadata and all reports to ``folder``.

    Reports are Parquet below ``reports``, and read back from there. ``without`` names the feature that the comparison
    refits without; it is left out where the model has no such feature.
    """
    run = risk.train(data, features, specs, draws)
    reports = {"metricas_modelos_cv": run.cv, "tuning": run.search, "metricas_teste": run.metrics}
    reports |= risk.explain_run(run, repeats)
    reports["risco_municipios"], reports["ranking_municipios"] = risk.risk_by_municipality(run.predictions, minimum)
    if without in run.fitted.numeric + run.fitted.categorical:
        comparison, verdict, predictions = risk.without_feature(run, without)
        reports["robustez"], reports["predicoes_robustez"] = comparison, predictions
        reports["robustez_resumo"] = risk.ablation_summary(run, without, comparison, verdict)
    save_run(f"{folder}/run", run.fitted.model, run.predictions, run.metadata)
    spark, out = data.sparkSession, {}
    for name, table in reports.items():
        table.write.mode("overwrite").parquet(f"{folder}/reports/{name}")
        out[name] = spark.read.parquet(f"{folder}/reports/{name}")
    if "robustez_resumo" in out:
        write_json(out["robustez_resumo"], f"{folder}/reports/robustez_resumo_json")
    return run, out
