"""Modelling table, exploration, training, explanation, risk roll-up and ablation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.functions.indicators import inverse_target
from lavra.functions.text import normalize_code
from lavra.operators import aggregate, evaluate, explain, models, profile, trees
from lavra.operators.columns import (
    constant_columns, curate, drop_leakage, numeric_and_categorical, require_columns, require_tables,
    select_existing,
)
from lavra.operators.joins import coverage, enrich
from lavra.operators.ranking import ranking_list, sorted_by
from lavra.operators.reshape import first_per_key
from lavra.operators.sampling import fallback_group, holdout, stratified_group_folds
from lavra.plans import literacy as fixed
from lavra.session import staged

KEY = "codigo_municipio"
ROW_ID = "row_index"
SCORE = "prob_risco_nao_alfabetizado"


@dataclass
class ModellingTable:
    data: DataFrame
    coverage: DataFrame
    summary: DataFrame
    leakage: list[str]


def modelling_table(
    students: DataFrame, municipalities: DataFrame, census: DataFrame, territory: DataFrame, order: Sequence[str] = ()
) -> ModellingTable:
    """Students with a known target, enriched by municipality, without leaking columns.

    ``order`` names the columns that say which of several municipal rows comes first.
    """
    tables = {"alunos": students, "municipios": municipalities, "censo": census, "ibge": territory}
    require_tables(tables, tables)
    for name, table in tables.items():
        require_columns(table, [KEY], name)
        tables[name] = table.withColumn(KEY, normalize_code(F.col(KEY).cast("string"), 7, clean=False))
    require_columns(students, ["alfabetizado_oficial"], "alunos")

    known = tables["alunos"].withColumn(fixed.TARGET, inverse_target(F.col("alfabetizado_oficial")))
    known = known.where(F.col(fixed.TARGET).isNotNull())
    first = [c for c in order if c in municipalities.columns]
    before = first_per_key(
        select_existing(tables["municipios"], [KEY, "pct_alfabetizados_2023", "meta_2024", *first]), [KEY], first
    )
    before = staged(select_existing(before, [KEY, "pct_alfabetizados_2023", "meta_2024"]), "before")
    schools = tables["censo"].drop(*fixed.CENSUS_IDENTITY.values())
    joined = enrich(known, before, [KEY])
    joined = enrich(joined, schools, [KEY], "_censo", duplicates="first")
    joined = enrich(joined, tables["ibge"], [KEY], "_ibge", duplicates="first")
    joined = staged(profile.coerce_numeric(joined, fixed.PROTECTED), "joined")

    signals = {}
    for source, table in (("Censo Escolar 2023", schools), ("IBGE 2022", tables["ibge"])):
        signal = next((c for c in table.columns if c != KEY), None)
        if signal in joined.columns:
            signals[source] = signal
    data, leaking = drop_leakage(joined, fixed.LEAKAGE)
    y = F.col(fixed.TARGET)
    summary = data.agg(
        F.count("*").alias("linhas"),
        F.lit(len(data.columns)).alias("colunas"),
        F.count_if(y == 1).alias("target_1_risco"),
        F.count_if(y == 0).alias("target_0_sem_risco"),
        F.round(100 * F.avg(y), 2).alias("taxa_risco_pct"),
        F.lit(";".join(leaking)).alias("leakage_removido"),
    )
    return ModellingTable(data, coverage(joined, signals), summary, leaking)


def curated(data: DataFrame) -> tuple[DataFrame, list[str], DataFrame]:
    """The curated feature table, its features, and the report on every column."""
    table, kept, constant = curate(data, fixed.AUDIT, fixed.FEATURES, fixed.TARGET)
    report = profile.feature_report(
        data, fixed.TARGET, fixed.AUDIT, kept, constant, fixed.EXCLUSION_REASONS, fixed.FATE_TEXTS
    )
    return table, kept, report


def exploration(data: DataFrame) -> dict[str, DataFrame]:
    """Summary, missing values, target distribution, correlations and rate per state."""
    numeric, _ = numeric_and_categorical(data, [c for c in data.columns if c != fixed.TARGET])
    out = {
        "resumo_geral": aggregate.dataset_summary(data, fixed.TARGET, fixed.SUMMARY_NAMES),
        "valores_ausentes": sorted_by(profile.column_profile(data), ("null_pct", True), ("column", False)),
        "distribuicao_target": sorted_by(
            aggregate.value_counts(data, fixed.TARGET, "quantidade", "percentual"), ("quantidade", True)
        ),
        "correlacoes_target": sorted_by(
            profile.correlation_ranking(data, numeric, fixed.TARGET, fixed.CORRELATION_MINIMUM),
            ("abs_correlation", True),
        ),
    }
    if "sigla_uf" in data.columns:
        rates = aggregate.rate_by_category(data, "sigla_uf", fixed.TARGET, "alunos", "taxa_risco", "taxa_risco_pct")
        out["risco_por_uf"] = sorted_by(rates, ("sigla_uf", False))
        # What the chart shows: states of enough students, from the lowest rate up.
        out["grafico_risco_por_uf"] = sorted_by(
            rates.where(F.col("alunos") >= fixed.CHART_MINIMUM), ("taxa_risco_pct", False), ("sigla_uf", False)
        )
    return out


@dataclass
class Training:
    cv: DataFrame
    best: str
    search: DataFrame
    fitted: models.Fitted
    metrics: DataFrame
    predictions: DataFrame
    metadata: DataFrame
    train: DataFrame
    test: DataFrame


def train(
    data: DataFrame, features: Sequence[str], specs: Sequence[models.ModelSpec] = models.MODELS,
    draws: int = 10, seed: int = fixed.SEED,
) -> Training:
    """Split by school, compare models by cross-validation, tune the best, judge it on the test rows.

    ``data`` holds a unique ``row_index``, or gets one from its student id.
    """
    if ROW_ID not in data.columns:
        data = data.withColumn(ROW_ID, F.col("id_aluno"))
    require_columns(data, [fixed.GROUP, fixed.TARGET], "training table")
    known = data.where(F.col(fixed.TARGET).isin(0, 1)).withColumn(fixed.TARGET, F.col(fixed.TARGET).cast("int"))
    known = staged(known.withColumn("_group", fallback_group(F.col(fixed.GROUP), F.col(ROW_ID))), "known")
    constant = constant_columns(known, features)
    numeric, categorical = numeric_and_categorical(known, [c for c in features if c not in constant])

    train_rows, test_rows = holdout(staged(stratified_group_folds(known, "_group", fixed.TARGET, 5, seed), "outer"))
    inner = staged(stratified_group_folds(train_rows, "_group", fixed.TARGET, 4, seed), "inner")
    cv = staged(models.cross_validate(inner, fixed.TARGET, numeric, categorical, specs), "cv")
    best = cv.agg(F.max_by("modelo", "pr_auc_media").alias("m")).first()["m"]
    spec = next(s for s in specs if s.name == best)
    fitted, search = models.random_search(inner, fixed.TARGET, numeric, categorical, spec, draws, seed=seed)

    keep = [c for c in (ROW_ID, *fixed.AUDIT[:4], "sigla_uf") if c in known.columns]
    predictions = staged(models.predict(fitted, test_rows, fixed.TARGET, keep, score=SCORE), "predictions")
    metrics = evaluate.binary_metrics(predictions, "y_real", SCORE, "y_pred")
    metadata = models.run_metadata(
        data.sparkSession, fitted, fixed.TARGET, fixed.GROUP, constant, metrics.first().asDict(),
        train_rows.count(), test_rows.count(), seed,
    )
    return Training(cv, best, search, fitted, metrics, predictions, metadata, train_rows, test_rows)


def explain_run(run: Training, repeats: int = 10) -> dict[str, DataFrame]:
    """Permutation importance and additive attribution.

    Linear models and ensembles of trees are attributed exactly, by slot and by feature.
    """
    out = {
        "permutation_importance": sorted_by(
            explain.permutation_importance(run.fitted, run.test, fixed.TARGET, ROW_ID, repeats),
            ("importance_mean", True),
        )
    }
    if run.fitted.spec.name == "logistic_regression":
        slots = explain.linear_attribution(run.fitted, run.test, run.train, ROW_ID)
    else:
        gains, _ = trees.tree_attribution(run.fitted.model.stages[-1], run.fitted.model.transform(run.test), ROW_ID)
        slots = trees.mean_attribution(gains, run.fitted.slots)
    slots = staged(slots, "slots")
    out["shap_importance_transformed"] = sorted_by(slots, ("mean_abs_shap", True))
    by_feature = explain.importance_rollup(slots)
    out["shap_importance"] = sorted_by(by_feature, ("mean_abs_shap", True))
    return out


def risk_by_municipality(predictions: DataFrame, minimum: int = fixed.RANKING_MINIMUM) -> tuple[DataFrame, DataFrame]:
    """Risk per municipality, and the ranking of those with enough students."""
    require_columns(predictions, [KEY, SCORE], "predictions")
    rolled = aggregate.score_rollup(
        predictions, [KEY, "nome_municipio", "sigla_uf"], SCORE, "y_pred", "y_real", fixed.ROLLUP_NAMES, minimum
    )
    rolled = staged(rolled, "rolled")
    tie = [c for c in (KEY, "nome_municipio", "sigla_uf") if c in rolled.columns]
    ranked = ranking_list(rolled, "risco_medio", tie, "ranking_risco_amostra", F.col("elegivel_ranking"))
    return rolled, sorted_by(ranked, ("ranking_risco_amostra", False))


def without_feature(run: Training, feature: str = "sigla_uf") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Refit on the same split and parameters without one feature.

    Returns the comparison of metrics, the verdict, and the predictions of the reduced model.
    """
    if feature not in run.fitted.numeric + run.fitted.categorical:
        raise ValueError(f"{feature} is no feature of the model")
    numeric = [c for c in run.fitted.numeric if c != feature]
    categorical = [c for c in run.fitted.categorical if c != feature]
    reduced = models.fit(run.train, fixed.TARGET, numeric, categorical, run.fitted.spec, run.fitted.params)
    keep = [c for c in (ROW_ID, *fixed.AUDIT[:4], "sigla_uf") if c in run.test.columns]
    predictions = staged(
        models.predict(reduced, run.test, fixed.TARGET, keep, "y_pred_sem_uf", "prob_risco_sem_uf"), "reduced"
    )
    metrics = evaluate.binary_metrics(predictions, "y_real", "prob_risco_sem_uf", "y_pred_sem_uf")
    comparison = evaluate.compare_metrics(run.metrics, metrics, f"modelo_com_{feature}", f"modelo_sem_{feature}")
    return comparison, evaluate.verdict(comparison, fixed.VERDICT_TEXTS, fixed.SMALL_DELTA), predictions


def ablation_summary(run: Training, feature: str, comparison: DataFrame, verdict: DataFrame) -> DataFrame:
    """One row: the original model, the feature taken away, how many are left, the changes of three metrics, and the verdict."""
    deltas = comparison.agg(*[
        F.max(F.when(F.col("metrica") == m, F.col("delta_absoluto"))).alias(f"delta_{m}") for m in ("pr_auc", "roc_auc", "balanced_accuracy")
    ])
    left = len([c for c in run.fitted.numeric + run.fitted.categorical if c != feature])
    text = verdict.select("interpretacao").first()["interpretacao"]
    return deltas.select(
        F.lit(run.best).alias("modelo_original"), F.lit(feature).alias("feature_removida"), F.lit(left).alias("features_restantes"),
        "*", F.lit(text).alias("interpretacao"),
    )
