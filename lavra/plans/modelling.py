"""Queries that prepare features, fit and judge models, and explain them.

The modelling table is the labelled documents: text measures and language as features, low quality
as the positive class, the document source as the group that no split may cut.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lavra.operators import categories, evaluate, explain, features, models, trees
from lavra.operators.joins import enrich
from lavra.operators.profile import describe
from lavra.operators.sampling import group_folds, holdout
from lavra.plans.rankings import GROUPS
from lavra.plans.registry import query
from lavra.session import staged

NUMERIC = ["n_chars", "n_words", "n_lines", "word_length"]
CATEGORICAL = ["lang"]
TARGET = "risk"
GROUP = "source"

# Smaller ensembles than the library's defaults keep the attribution of trees affordable.
QUERY_MODELS = (
    models.LOGISTIC,
    models.ModelSpec("random_forest", params={"n_estimators": 40, "max_depth": 8}),
    models.ModelSpec("hist_gradient_boosting", encoding="ordinal", weighted=False, params={"max_iter": 10}),
)


def modelling_table(t):
    # Only labelled texts are split into words.
    labelled_texts = t.documents.join(t.labels.select("doc_id").distinct(), "doc_id", "left_semi")
    measured = staged(labelled_texts.select(
        "doc_id", "lang", GROUP, "n_chars",
        F.size(F.split(F.trim("text"), r"\s+")).alias("n_words"),
        F.when(F.contains(F.col("text"), F.lit("\n")), F.size(F.split("text", "\n"))).alias("n_lines"),
    ).withColumn("word_length", F.try_divide(F.col("n_chars").cast("double"), "n_words")), "texts")
    labelled = enrich(t.labels, measured, ["doc_id"])
    return labelled.withColumn(TARGET, 1 - F.col("quality"))


def _split(t):
    folded = group_folds(staged(modelling_table(t), "modelling"), GROUP, TARGET, 5)
    train, test = holdout(staged(folded, "folded"))
    return train, test


def _fitted(t):
    train, test = _split(t)
    return models.fit(train, TARGET, NUMERIC, CATEGORICAL, models.LOGISTIC), train, test


PREPARED = """with d as (select n_chars, case when text like '%
%' then len(string_split(text, chr(10))) end as n_lines, lang from documents),
n as (select n_chars::double as x, 'n_chars' as feature from d union all select n_lines::double, 'n_lines' from d),
med as (select feature, median(x) as m from n group by 1),
c as (select lang, count(*) as k from d group by 1)
select feature, 'median' as statistic, round(m, 6) as value, null as text from med
union all select feature, 'mean', round(avg(coalesce(x, m)), 4), null from n join med using (feature) group by 1
union all select feature, 'std', round(stddev_pop(coalesce(x, m)), 4), null from n join med using (feature) group by 1
union all select 'lang', 'mode', null, (select lang from c order by k desc, lang limit 1)
union all select 'lang', 'category', row_number() over (order by lang) - 1.0, lang from c where k >= 2
union all select 'lang', 'pooled', null, lang from c where k < 2"""


@query(PREPARED)
def impute_scale_encode(t):
    rows = t.documents.select(
        "n_chars", "lang",
        F.when(F.contains(F.col("text"), F.lit("\n")), F.size(F.split("text", "\n"))).alias("n_lines"),
    )
    fitted = features.fit_preparation(staged(rows, "measures"), ["n_chars", "n_lines"], ["lang"])
    digits = F.when(F.col("statistic") == "median", F.round("value", 6)).otherwise(F.round("value", 4))
    return features.preparation_table(t.spark, fitted).withColumn("value", digits)


@query("""
select 'l_extendedprice' as feature, median(l_extendedprice) as median from lineitem
union all select 'l_quantity', median(l_quantity) from lineitem
union all select 'l_discount', median(l_discount) from lineitem""")
def exact_medians(t):
    columns = ["l_extendedprice", "l_quantity", "l_discount"]
    found = features.exact_medians(t.lineitem, columns)
    return t.spark.createDataFrame([(c, found[c]) for c in columns], "feature string, median double")


@query("""
with c as (select o_orderpriority as v, count(*) as n from orders where o_orderpriority is not null group by 1),
s as (select o_orderstatus as v, count(*) as n from orders where o_orderstatus is not null group by 1)
select 'o_orderpriority' as "column", (select v from c order by n desc, v limit 1) as mode
union all select 'o_orderstatus', (select v from s order by n desc, v limit 1)""")
def most_frequent(t):
    return categories.modes(categories.category_counts(t.orders, ["o_orderpriority", "o_orderstatus"]))


@query("""
with v as (select coalesce(case when l_orderkey % 11 > 0 then l_orderkey || '-' || l_linenumber % 5 end,
    (select min(l_orderkey || '-' || l_linenumber % 5) from (
      select *, count(*) over (partition by l_orderkey, l_linenumber % 5) as n from lineitem where l_orderkey % 11 > 0) w
      where n = (select max(k) from (select count(*) as k from lineitem where l_orderkey % 11 > 0 group by l_orderkey, l_linenumber % 5)))) as value,
  l_orderkey % 11 = 0 as missing from lineitem),
c as (select value, count(*) as n from v group by 1),
p as (select value, n, row_number() over (order by value) - 1 as place, count(*) filter (n >= 2) over (order by value) - 1 as kept,
  (select count(*) from c where n >= 2) as width from c)
select place::int as place, (case when n >= 2 then kept else width end)::int as slot, n as rows from p""")
def many_categories(t):
    """A category for most of the rows: numbered, and looked up again by every row."""
    code = F.concat_ws("-", "l_orderkey", F.col("l_linenumber") % 5)
    rows = t.lineitem.select(F.when(F.col("l_orderkey") % 11 > 0, code).alias("code"))
    fitted = categories.fit_dictionary(rows, ["code"])
    mode, table = fitted.columns["code"][0], fitted.table(t.spark)
    both = categories.encode(rows, table, "code", mode, {"place": "place", "slot": "slot"}, fitted.bytes)
    return both.groupBy("place", "slot").agg(F.count("*").alias("rows"))


@query()
def encoded_features(t):
    """The assembled vector of the linear flavour, described slot by slot."""
    train, test = _split(t)
    prepared, slots = features.assemble(
        t.spark, features.fit_preparation(train, NUMERIC, CATEGORICAL), True, "onehot"
    )
    slots = categories.slot_names(slots)
    array = prepared.transform(test).select(vector_to_array("features").alias("x"))
    wide = array.select(*[F.col("x")[i].alias(s) for i, s in enumerate(slots)])
    return describe(wide, slots)


def _scored_lines(t):
    """Lines with a score from the hash of their keys: many distinct scores, some ties."""
    digest = F.md5(F.concat_ws(":", "l_orderkey", "l_linenumber"))
    score = F.conv(F.substring(digest, 1, 3), 16, 10).cast("double") / 4096
    scored = t.lineitem.select(
        "l_linestatus", score.alias("score"), (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (score >= 0.5).cast("int").alias("pred"),
    )
    # Like a model's predictions, the scores are written once and then judged.
    return staged(scored, "scored")


SCORED = """d as (select l_linestatus, cast(l_returnflag = 'R' as int) as y,
  ('0x' || substr(md5(l_orderkey || ':' || l_linenumber), 1, 3))::bigint / 4096.0 as score from lineitem),
s as (select l_linestatus, score, count(*) filter (y = 1) as tp, count(*) filter (y = 0) as fp from d group by 1, 2),
k as (select *, sum(tp) over w as ctp, sum(fp) over w as cfp, sum(tp) over (partition by l_linestatus) as p,
  sum(fp) over (partition by l_linestatus) as n from s window w as (partition by l_linestatus order by score desc))"""


@query(f"""with {SCORED},
r as (select l_linestatus, sum(fp * (ctp - tp / 2.0)) / (max(p) * max(n)) as roc_auc,
  sum(tp * ctp / (ctp + cfp)) / max(p) as pr_auc from k group by 1),
c as (select l_linestatus, count(*) filter (y = 1 and score >= 0.5)::double as tp,
  count(*) filter (y = 0 and score >= 0.5)::double as fp, count(*) filter (y = 1 and score < 0.5)::double as fn,
  count(*) filter (y = 0 and score < 0.5)::double as tn from d group by 1)
select l_linestatus, round((tp + tn) / (tp + fp + fn + tn), 8) as accuracy,
  round((tp / (tp + fn) + tn / (tn + fp)) / 2, 8) as balanced_accuracy, round(tp / (tp + fp), 8) as precision,
  round(tp / (tp + fn), 8) as recall, round(2 * tp / (2 * tp + fp + fn), 8) as f1,
  round(roc_auc, 8) as roc_auc, round(pr_auc, 8) as pr_auc from c join r using (l_linestatus)""")
def binary_metrics(t):
    out = evaluate.binary_metrics(_scored_lines(t), "y", "score", "pred", ["l_linestatus"])
    return out.select("l_linestatus", *[F.round(m, 8).alias(m) for m in evaluate.METRICS])


@query(f"""with {SCORED}
select l_linestatus, score as threshold, ctp::bigint as tp, cfp::bigint as fp, round(ctp / p, 8) as tpr,
  round(cfp / n, 8) as fpr, round(ctp / (ctp + cfp), 8) as precision from k""")
def curve_points(t):
    out = evaluate.curve_points(_scored_lines(t), "y", "score", ["l_linestatus"])
    rates = ("tpr", "fpr", "precision")
    return out.select("l_linestatus", "threshold", "tp", "fp", *[F.round(c, 8).alias(c) for c in rates])


@query(f"with {SCORED} select y, cast(score >= 0.5 as int) as pred, count(*) as n from d group by 1, 2")
def confusion(t):
    return evaluate.confusion(_scored_lines(t), "y", "pred")


RISK_ROWS = ("d as (select doc_id, source as grp, 1 - quality as y, lang, n_chars from documents join labels using (doc_id)), "
             + GROUPS.format(k=5) + ", e as (select d.* from d join f using (grp) where fold > 0)")


@query(f"""with {RISK_ROWS},
l as (select coalesce(lang, (select lang from e where lang is not null group by 1 order by count(*) desc, lang limit 1)) as lang from e),
c as (select lang, count(*) as k from l group by 1),
s as (select 'cat__lang_' || case when k >= 2 then lang else '__pooled__' end as name from c group by 1
  union all select unnest(['num__n_chars', 'num__n_words', 'num__n_lines', 'num__word_length', 'intercept']))
select name, true as settled from s""")
def logistic_gradient(t):
    """The gradient of the penalised, weighted loss at the fitted coefficients, slot by slot: zero where the fit has settled."""
    train, _ = _split(t)
    ready = models.prepare(train, TARGET, NUMERIC, CATEGORICAL, models.LOGISTIC)
    fitted = ready.fit(models.LOGISTIC)
    model = fitted.model.stages[-1]
    scored = model.transform(ready.vectors).withColumn("_r", F.col("weight") * (vector_to_array("probability")[1] - F.col("label")))
    total = scored.agg(F.sum("weight")).first()[0]
    # One row per slot: the model's own coefficients.
    coefficients = t.spark.createDataFrame(list(enumerate(model.coefficients.toArray().tolist())), "slot int, beta double")
    penalty = 1.0 / ready.rows
    parts = scored.select("_r", F.posexplode(vector_to_array("features")).alias("slot", "x"))
    slopes = parts.groupBy("slot").agg((F.sum(F.col("_r") * F.col("x")) / total).alias("g")).join(coefficients, "slot")
    slopes = slopes.join(fitted.slots, "slot").select("name", (F.col("g") + penalty * F.col("beta")).alias("g"))
    intercept = scored.agg((F.sum("_r") / total).alias("g")).select(F.lit("intercept").alias("name"), "g")
    return slopes.unionByName(intercept).select("name", (F.abs("g") < 1e-4).alias("settled"))


@query(f"""with {RISK_ROWS}
select y::double as label, round(count(*) over () / (2.0 * count(*) over (partition by y)), 8) as weight, count(*) over (partition by y) as rows from e
qualify row_number() over (partition by y) = 1""")
def class_weights(t):
    train, _ = _split(t)
    vectors = models.prepare(train, TARGET, NUMERIC, CATEGORICAL, models.LOGISTIC).vectors
    return vectors.groupBy("label", F.round("weight", 8).alias("weight")).agg(F.count("*").alias("rows"))


@query(f"""with {RISK_ROWS},
l as (select coalesce(lang, (select lang from e where lang is not null group by 1 order by count(*) desc, lang limit 1)) as lang from e),
c as (select lang, count(*) as k from l group by 1),
n as (select case when k >= 2 then lang else '__pooled__' end as lang, sum(k) as k from c group by 1)
select 'cat__lang_' || lang as name, round(k::double / (select count(*) from e), 6) + 0.0 as mean,
  round(sqrt(k::double / (select count(*) from e) * (1 - k::double / (select count(*) from e))), 6) + 0.0 as std from n
union all select unnest(['num__n_chars', 'num__n_words', 'num__n_lines', 'num__word_length']), 0.0, 1.0""")
def slot_moments(t):
    """Mean and deviation of every slot over the training rows: scaled numbers, and shares of the categories."""
    train, _ = _split(t)
    ready = models.prepare(train, TARGET, NUMERIC, CATEGORICAL, models.LOGISTIC)
    parts = ready.vectors.select(F.posexplode(vector_to_array("features")).alias("slot", "x"))
    moments = parts.groupBy("slot").agg(
        (F.round(F.avg("x"), 6) + F.lit(0.0)).alias("mean"), (F.round(F.stddev_pop("x"), 6) + F.lit(0.0)).alias("std")
    )
    return moments.join(ready.slots, "slot").select("name", "mean", "std")


@query(f"""with {SCORED},
c as (select l_linestatus, count(*) filter (y = 1 and score >= 0.5)::double as tp, count(*) filter (y = 0 and score >= 0.5)::double as fp,
  count(*) filter (y = 1 and score < 0.5)::double as fn, count(*) filter (y = 0 and score < 0.5)::double as tn from d group by 1),
m as (select (tp + tn) / (tp + fp + fn + tn) as accuracy, 2 * tp / (2 * tp + fp + fn) as f1, tp / (tp + fn) as recall from c)
select 'given' as modelo, round(avg(accuracy), 8) as accuracy_media, round(stddev_pop(accuracy), 8) + 0.0 as accuracy_std,
  round(avg(f1), 8) as f1_media, round(stddev_pop(f1), 8) + 0.0 as f1_std, round(avg(recall), 8) as recall_media, round(stddev_pop(recall), 8) + 0.0 as recall_std from m""")
def fold_metrics(t):
    """Metrics of given scores over folds, as cross-validation rolls them up."""
    scores = _scored_lines(t).withColumn("modelo", F.lit("given"))
    rolled = evaluate.mean_over_folds(scores, "l_linestatus")
    return rolled.select("modelo", *[
        (F.round(f"{m}_{k}", 8) + F.lit(0.0)).alias(f"{m}_{k}") for m in ("accuracy", "f1", "recall") for k in ("media", "std")
    ])


@query()
def model_cv(t):
    train, _ = _split(t)
    folded = staged(group_folds(train, GROUP, TARGET, 4), "inner")
    return models.cross_validate(folded, TARGET, NUMERIC, CATEGORICAL)


@query()
def model_search(t):
    train, _ = _split(t)
    folded = staged(group_folds(train, GROUP, TARGET, 4), "inner")
    return models.random_search(folded, TARGET, NUMERIC, CATEGORICAL, models.LOGISTIC, draws=3)[1]


@query()
def model_holdout(t):
    fitted, _, test = _fitted(t)
    return evaluate.binary_metrics(models.predict(fitted, test, TARGET), "y_real", "score", "y_pred")


@query()
def model_predictions(t):
    fitted, _, test = _fitted(t)
    return models.predict(fitted, test, TARGET, ["doc_id", GROUP])


@query("""with d as (select doc_id, source as grp, 1 - quality as y from documents join labels using (doc_id)), """
       + GROUPS.format(k=5) + """
select 'logistic_regression' as best_model, 'risk' as target, ['n_chars', 'n_words', 'n_lines', 'word_length', 'lang'] as features,
  count(*) filter (fold > 0) as train_rows, count(*) filter (fold = 0) as test_rows from d join f using (grp)""")
def model_metadata(t):
    fitted, train, test = _fitted(t)
    scores = evaluate.binary_metrics(models.predict(fitted, test, TARGET), "y_real", "score", "y_pred")
    found = scores.first().asDict()
    return models.run_metadata(t.spark, fitted, TARGET, GROUP, [], found, train.count(), test.count()).select(
        "best_model", "target", "features", "train_rows", "test_rows"
    )


@query()
def permutation_importance(t):
    fitted, _, test = _fitted(t)
    return explain.permutation_importance(fitted, test, TARGET, "doc_id", repeats=10)


@query()
def linear_attribution(t):
    fitted, train, test = _fitted(t)
    return explain.linear_attribution(fitted, test, train, "doc_id")


@query()
def attribution_by_feature(t):
    fitted, train, test = _fitted(t)
    return explain.importance_rollup(explain.linear_attribution(fitted, test, train, "doc_id", None, None))


@query()
def sampled_attribution(t):
    train, test = _split(t)
    forest = models.fit(train, TARGET, NUMERIC, CATEGORICAL, QUERY_MODELS[1])
    return explain.sampled_attribution(forest, test, train, "doc_id")


@query("""with d as (select doc_id, source as grp, 1 - quality as y from documents join labels using (doc_id)), """
       + GROUPS.format(k=5) + """
select doc_id, kind, 0.0::double as gap from d join f using (grp), (values ('random_forest'), ('hist_gradient_boosting')) k(kind) where fold = 0""")
def tree_attribution(t):
    """What the gains of each document leave of its score, for a forest and a boosted ensemble."""
    train, test = _split(t)
    out = []
    for spec in QUERY_MODELS[1:]:
        fitted = models.fit(train, TARGET, NUMERIC, CATEGORICAL, spec)
        scored = staged(fitted.model.transform(test).select("doc_id", "features", "rawPrediction", "probability"), "scored")
        gains, base = trees.tree_attribution(fitted.model.stages[-1], scored, "doc_id")
        if spec.name == "random_forest":
            score = vector_to_array("probability")[1]
        else:
            score = 2 * vector_to_array("rawPrediction")[1]
        total = gains.groupBy("doc_id").agg(F.sum("gain").alias("gain"))
        gap = F.round(score - F.lit(base) - F.coalesce("gain", F.lit(0.0)), 6) + F.lit(0.0)
        out.append(scored.join(total, "doc_id", "left").select("doc_id", F.lit(spec.name).alias("kind"), gap.alias("gap")))
    return out[0].unionByName(out[1])


@query("""
select split_part(slot, '=', 1) as feature_original, round(sum(v), 6) as mean_abs_shap from (
  select 'status=' || l_linestatus as slot, avg(l_discount) as v from lineitem group by 1
  union all select 'flag=' || l_returnflag, avg(l_tax) from lineitem group by 1) group by 1""")
def importance_rollup(t):
    def slots(name, column, value):
        slot = F.concat(F.lit(f"cat__{name}_"), F.col(column))
        return t.lineitem.groupBy(slot.alias("slot")).agg(F.avg(value).alias("mean_abs_shap"))

    importance = slots("status", "l_linestatus", "l_discount").unionByName(slots("flag", "l_returnflag", "l_tax"))
    named = importance.withColumn("feature_original", explain.source_of("slot", ["status", "flag"]))
    rolled = explain.importance_rollup(named)
    return rolled.withColumn("mean_abs_shap", F.round("mean_abs_shap", 6))


def _ablation(t):
    train, test = _split(t)
    scored = {}
    for name, numeric in (("with", NUMERIC), ("without", [c for c in NUMERIC if c != "n_lines"])):
        fitted = models.fit(train, TARGET, numeric, CATEGORICAL, models.LOGISTIC)
        scored[name] = evaluate.binary_metrics(models.predict(fitted, test, TARGET), "y_real", "score", "y_pred")
    return evaluate.compare_metrics(scored["with"], scored["without"], "with_feature", "without_feature")


@query()
def ablation(t):
    return _ablation(t)


@query()
def ablation_verdict(t):
    return evaluate.verdict(_ablation(t), {"small": "small drop", "large": "relevant drop"})


@query(f"""with {SCORED},
r as (select l_linestatus, sum(fp * (ctp - tp / 2.0)) / (max(p) * max(n)) as roc_auc,
  sum(tp * ctp / (ctp + cfp)) / max(p) as pr_auc from k group by 1),
w as (select max(case when l_linestatus = 'F' then roc_auc end) as fr, max(case when l_linestatus = 'O' then roc_auc end) as o_r,
  max(case when l_linestatus = 'F' then pr_auc end) as fp, max(case when l_linestatus = 'O' then pr_auc end) as op from r)
select 'roc_auc' as metrica, round(fr, 8) as finished, round(o_r, 8) as "open", round(o_r - fr, 8) + 0.0 as delta_absoluto,
  round(100 * (o_r - fr) / fr, 6) + 0.0 as delta_percentual from w
union all select 'pr_auc', round(fp, 8), round(op, 8), round(op - fp, 8) + 0.0, round(100 * (op - fp) / fp, 6) + 0.0 from w""")
def metric_comparison(t):
    scored = _scored_lines(t)
    sides = [
        evaluate.binary_metrics(scored.where(F.col("l_linestatus") == s), "y", "score", "pred") for s in ("F", "O")
    ]
    both = evaluate.compare_metrics(*sides, "finished", "open").where(F.col("metrica").isin("roc_auc", "pr_auc"))
    return both.select(
        "metrica", F.round("finished", 8).alias("finished"), F.round("open", 8).alias("open"),
        (F.round("delta_absoluto", 8) + F.lit(0.0)).alias("delta_absoluto"),
        (F.round("delta_percentual", 6) + F.lit(0.0)).alias("delta_percentual"),
    )
