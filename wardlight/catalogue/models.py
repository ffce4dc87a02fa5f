"""Features, training, evaluation, explanation and scoring."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from wardlight import fixed_values as fv
from wardlight.catalogue import oracle as o
from wardlight.catalogue.registry import Inputs, query
from wardlight.catalogue.relational import MEDIAN_COLS, PLACED
from wardlight.ml import explain, metrics, scoring, split, train
from wardlight.operators import aggregates as agg
from wardlight.operators import joins
from wardlight.plans import features
from wardlight.workspace import stage

M = "mart_hospital_performance"
LABEL, TARGET, KEY = "readmission_risk_label", "composite_quality_score", "provider_id"


@query("build_features", "SELECT * FROM features_raw", o.FEATURE_DOUBLES)
def _(i: Inputs):
    return features.build_features(i.performance)


IMPUTED = MEDIAN_COLS


@query("impute_median", f"SELECT provider_id, " + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), (SELECT coalesce(CAST(median({c}) AS DOUBLE), 0) FROM {M})) AS {c}" for c in IMPUTED)
    + f" FROM {M}", IMPUTED)
def _(i: Inputs):
    return features.impute_median(i.performance.select(KEY, *IMPUTED), IMPUTED)


@query("fill_target", f"""
SELECT provider_id, coalesce(overall_patient_experience_score, (SELECT median(overall_patient_experience_score) FROM {M}))
       AS target, coalesce(CASE WHEN overall_rating >= 3 THEN 'High' END, 'Medium') AS label FROM {M}""", ["target"])
def _(i: Inputs):
    rows = i.performance.select(KEY, F.col("overall_patient_experience_score").alias("target"),
                                F.when(F.col("overall_rating") >= 3, "High").alias("label"))
    return features.fill_target(features.fill_target(rows, "target", "median"), "label", "label")


@query("numeric_features", " UNION ALL ".join(
    f"SELECT {o.q(c)} AS feature, count({c}) AS known FROM features_raw" for c in o.FEATURE_NUMERIC if c != TARGET))
def _(i: Inputs):
    built = features.build_features(i.performance)
    names = features.numeric_features(built, [TARGET])
    row = built.agg(*[F.count(c).alias(c) for c in names])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("known")) for c in names])
    return row.select(F.explode(pairs).alias("p")).select("p.feature", "p.known")


# ---- splits ----------------------------------------------------------------

def _parts(train_rows, test_rows):
    return train_rows.withColumn("part", F.lit("train")).unionByName(test_rows.withColumn("part", F.lit("test")))


@query("random_split", f"""
SELECT c_custkey, CASE WHEN {o.seeded_hash('c_custkey', fv.SEED)} % 1000000 < 200000 THEN 'test' ELSE 'train' END AS part FROM customer""")
def _(i: Inputs):
    return _parts(*split.split(i.table("customer").select("c_custkey"), "c_custkey"))


@query("stratified_split", """
SELECT c_mktsegment, part, CASE part WHEN 'test' THEN test ELSE n - test END AS n
FROM (SELECT c_mktsegment, count(*) AS n, CAST(round(count(*) * 0.2) AS BIGINT) AS test FROM customer GROUP BY 1)
CROSS JOIN (VALUES ('train'), ('test')) p(part)""")
def _(i: Inputs):
    rows = i.table("customer").select("c_custkey", "c_mktsegment")
    both = _parts(*split.split(rows, "c_custkey", strata="c_mktsegment"))
    return both.groupBy("c_mktsegment", "part").agg(F.count(F.lit(1)).alias("n"))


@query("stratified_folds", """
SELECT c_mktsegment, CAST(fold AS INTEGER) AS fold, n // 5 + CASE WHEN fold > 0 AND fold <= n % 5 THEN 1 ELSE 0 END AS n
FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1) CROSS JOIN range(5) f(fold)""")
def _(i: Inputs):
    rows = split.with_folds(i.table("customer").select("c_custkey", "c_mktsegment"), "c_custkey", strata="c_mktsegment")
    return rows.groupBy("c_mktsegment", "fold").agg(F.count(F.lit(1)).alias("n"))


@query("random_folds", f"""
SELECT c_custkey, CAST({o.seeded_hash('c_custkey', fv.SEED)} % 5 AS INTEGER) AS fold FROM customer""")
def _(i: Inputs):
    return split.with_folds(i.table("customer").select("c_custkey"), "c_custkey")


# ---- evaluation ------------------------------------------------------------

LABELS = "(SELECT quality AS t, toxic AS p FROM labels)"


@query("confusion_matrix", f"SELECT t AS truth, p AS predicted, count(*) AS n FROM {LABELS} GROUP BY t, p")
def _(i: Inputs):
    return metrics.confusion_matrix(i.table("labels"), "quality", "toxic")


CLASS_SQL = f"""
SELECT class, n_true, n_predicted, n_hit, CASE WHEN n_predicted > 0 THEN CAST(n_hit AS DOUBLE) / n_predicted ELSE 0 END AS precision,
       CASE WHEN n_true > 0 THEN CAST(n_hit AS DOUBLE) / n_true ELSE 0 END AS recall,
       CASE WHEN n_true + n_predicted > 0 THEN 2.0::DOUBLE * n_hit / (n_true + n_predicted) ELSE 0 END AS f1
FROM (SELECT c.class, (SELECT count(*) FROM {LABELS} WHERE t = c.class) AS n_true,
             (SELECT count(*) FROM {LABELS} WHERE p = c.class) AS n_predicted,
             (SELECT count(*) FROM {LABELS} WHERE t = c.class AND p = c.class) AS n_hit
      FROM (SELECT t AS class FROM {LABELS} UNION SELECT p FROM {LABELS}) c)"""


@query("class_metrics", CLASS_SQL, ["precision", "recall", "f1"])
def _(i: Inputs):
    return metrics.class_metrics(i.table("labels"), "quality", "toxic")


@query("macro_f1", f"SELECT avg(f1) AS macro_f1 FROM ({CLASS_SQL})", ["macro_f1"])
def _(i: Inputs):
    return metrics.macro_f1(i.table("labels"), "quality", "toxic")


def _auc_sql(label: int, score: str) -> str:
    return f"""
SELECT '{label}' AS class, (sum(CASE WHEN hit THEN place END) - p * (p + 1) / 2) / (p * (n - p)) AS auc
FROM (SELECT hit, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0::DOUBLE AS place,
             CAST(count(*) FILTER (WHERE hit) OVER () AS DOUBLE) AS p, CAST(count(*) OVER () AS DOUBLE) AS n
      FROM (SELECT quality = {label} AS hit, {score} AS s FROM labels JOIN documents USING (doc_id))) GROUP BY p, n"""


STATUS_SCORES = {"F": "o_totalprice", "O": "o_custkey", "P": "o_orderkey"}


def _status_auc() -> str:
    return " UNION ALL ".join(f"""
SELECT (sum(CASE WHEN hit THEN place END) - p * (p + 1) / 2) / (p * (n - p)) AS auc
FROM (SELECT hit, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0::DOUBLE AS place,
             CAST(count(*) FILTER (WHERE hit) OVER () AS DOUBLE) AS p, CAST(count(*) OVER () AS DOUBLE) AS n
      FROM (SELECT o_orderstatus = '{c}' AS hit, {score} AS s FROM orders)) GROUP BY p, n""" for c, score in STATUS_SCORES.items())


@query("auc_one_vs_rest", f"{_auc_sql(0, '-n_chars')} UNION ALL {_auc_sql(1, 'n_chars')}", ["auc"])
def _(i: Inputs):
    rows = i.table("labels").join(i.table("documents").select("doc_id", "n_chars"), "doc_id").select(
        "quality", "n_chars", (-F.col("n_chars")).alias("minus_chars"))
    return metrics.auc_ovr(rows, "quality", {0: "minus_chars", 1: "n_chars"})


@query("macro_auc", f"SELECT avg(auc) AS macro_auc FROM ({_status_auc()})", ["macro_auc"])
def _(i: Inputs):
    """Of three classes, each with a score of its own."""
    rows = i.table("orders").select("o_orderstatus", "o_totalprice", "o_orderkey", "o_custkey")
    return metrics.macro_auc(rows, "o_orderstatus", {c: F.col(score).cast("double") for c, score in STATUS_SCORES.items()})


@query("regression_report", """
SELECT count(*) AS n, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae, 1 - avg(e * e) / var_pop(y) AS r2,
       1 - var_pop(e) / var_pop(y) AS explained_variance
FROM (SELECT l_extendedprice AS y, l_extendedprice - 1500 * l_quantity AS e FROM lineitem)""",
       ["rmse", "mae", "r2", "explained_variance"])
def _(i: Inputs):
    rows = i.table("lineitem").select("l_extendedprice", (F.col("l_quantity") * 1500).alias("guess"))
    return metrics.regression_report(rows, "l_extendedprice", "guess")


# ---- models ----------------------------------------------------------------
#
# What a model finds has no SQL; what must hold of it for every facility has, in the queries named *_facts.

@query("classifier_predictions")
def _(i: Inputs):
    return i.risk_model.transform(i.features).select(KEY, LABEL, "predicted_label", "probabilities")


@query("classifier_facts", f"""
SELECT provider_id, {LABEL}, (SELECT count(DISTINCT {LABEL}) FROM features) AS n_probabilities, true AS sums_to_one,
       true AS best_is_predicted, true AS known_label FROM features""")
def _(i: Inputs):
    """Probabilities of all classes add up to one, and the predicted class, one of those given, has the highest."""
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, b: a + b)
    known = i.features.select(F.col(LABEL).alias("predicted_label")).distinct().withColumn("known", F.lit(True))
    out = i.risk_model.transform(i.features).join(known, "predicted_label", "left")
    return out.select(KEY, LABEL, F.size("probabilities").cast("bigint").alias("n_probabilities"), (F.abs(total - 1) < 1e-9).alias("sums_to_one"),
                      (F.get("probabilities", F.col("predicted_index")) == F.array_max("probabilities")).alias("best_is_predicted"),
                      F.coalesce("known", F.lit(False)).alias("known_label"))


@query("regressor_predictions")
def _(i: Inputs):
    return i.quality_model.transform(i.features).select(KEY, TARGET, "predicted_quality")


@query("holdout_classification_report")
def _(i: Inputs):
    """Tuned and trained on 80 %, measured on the other 20 %, both drawn per class."""
    fitted, held = i.risk_training
    return metrics.class_metrics(fitted.model.transform(held), LABEL, "predicted_label")


@query("holdout_regression_report")
def _(i: Inputs):
    fitted, held = i.quality_training
    return metrics.regression_report(fitted.model.transform(held), TARGET, "predicted_quality")


@query("holdout_facts", f"""
SELECT {LABEL} AS class, CAST(round(count(*) * 0.2) AS BIGINT) AS n_true FROM features GROUP BY 1 HAVING round(count(*) * 0.2) > 0
UNION ALL SELECT 'all, regression', count(*) FROM features WHERE {o.seeded_hash('provider_id', fv.SEED)} % 1000000 < 200000""")
def _(i: Inputs):
    """The rows that the reports are about: a fifth of each class, and a fifth of all."""
    i.models
    (risk, held), (quality, others) = i.risk_training, i.quality_training
    classes = metrics.class_metrics(risk.model.transform(held), LABEL, "predicted_label").where("n_true > 0").select("class", "n_true")
    report = metrics.regression_report(quality.model.transform(others), TARGET, "predicted_quality")
    return classes.union(report.select(F.lit("all, regression"), "n"))


def _with_settings(report, fitted: train.Fitted, score: str):
    return report.withColumns({score: F.lit(fitted.score)} | {c: F.lit(v) for c, v in train.settings_row(fitted).items()})


@query("tuned_classifier")
def _(i: Inputs):
    """Metrics of the part held out: per class, the macro AUC over probabilities, and the settings that the folds chose."""
    fitted, held = i.risk_training
    scored = stage(fitted.model.transform(held), "scored")
    report = metrics.class_metrics(scored, LABEL, "predicted_label")
    area = metrics.probability_auc(scored, LABEL, fitted.model.labels).withColumnRenamed("macro_auc", "auc_roc_macro")
    return _with_settings(report.crossJoin(F.broadcast(area)), fitted, "cv_best_score_f1_macro")  # one row


@query("tuned_regressor")
def _(i: Inputs):
    fitted, held = i.quality_training
    report = metrics.regression_report(fitted.model.transform(held), TARGET, "predicted_quality")
    return _with_settings(report, fitted, "cv_best_score_neg_rmse")


@query("holdout_confusion")
def _(i: Inputs):
    fitted, held = i.risk_training
    return metrics.confusion_matrix(fitted.model.transform(held), LABEL, "predicted_label")


def _grid_sql(grid) -> str:
    names = list(grid)
    values = ", ".join(f"(VALUES {', '.join(f'({v})' for v in grid[c])}) {c}_values({c})" for c in names)
    return f"SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in names)}, true AS scored FROM {values}"


def _grid_rows(i: Inputs, fitted: train.Fitted, grid, ok):
    rows = [(*[float(options[c]) for c in grid], ok(score)) for options, score in fitted.scores]
    return i.spark.createDataFrame(rows, ", ".join(f"{c} double" for c in grid) + ", scored boolean")


@query("classifier_grid", _grid_sql(fv.CLASSIFIER_GRID))
def _(i: Inputs):
    """Every combination of the grid was tried on all folds."""
    return _grid_rows(i, i.risk_training[0], fv.CLASSIFIER_GRID, lambda score: 0.0 <= score <= 1.0)


@query("regressor_grid", _grid_sql(fv.REGRESSOR_GRID))
def _(i: Inputs):
    return _grid_rows(i, i.quality_training[0], fv.REGRESSOR_GRID, lambda score: score <= 0.0)


def _reloaded(i: Inputs):
    risk, quality = (train.Model.load(i.spark, i.stored_models[name]) for name in ("readmission_classifier", "quality_regressor"))
    return quality.transform(risk.transform(i.features))


@query("stored_models")
def _(i: Inputs):
    """Both models written, read back and applied."""
    return _reloaded(i).select(KEY, "predicted_label", "predicted_quality")


@query("stored_model_facts", "SELECT provider_id, true AS same_label, true AS same_probabilities, true AS same_quality FROM features")
def _(i: Inputs):
    """Models read back say what they said before."""
    risk, quality = i.models
    before = quality.transform(risk.transform(i.features))
    columns = ["predicted_label", "probabilities", "predicted_quality"]
    after = _reloaded(i).select(KEY, *[F.col(c).alias(f"{c}_after") for c in columns])
    return before.join(after, KEY).select(KEY, *[(F.col(c) == F.col(f"{c}_after")).alias(name) for c, name in
                                                 zip(columns, ("same_label", "same_probabilities", "same_quality"))])


@query("contribution_facts", "SELECT provider_id, true AS classifier_adds_up, true AS regressor_adds_up FROM features")
def _(i: Inputs):
    """Base value and contributions of every facility and class make the model's margin."""
    ok = lambda model, name: explain.additive(i.features, model).select(KEY, (F.col("gap") < 1e-6).alias(name))
    risk, quality = i.models
    return ok(risk, "classifier_adds_up").join(ok(quality, "regressor_adds_up"), KEY)


@query("shap_classifier")
def _(i: Inputs):
    return explain.shap_values(i.risk_model, i.features)


@query("shap_regressor")
def _(i: Inputs):
    return explain.shap_values(i.quality_model, i.features)


@query("shap_importance")
def _(i: Inputs):
    return agg.mean_abs(explain.shap_values(i.quality_model, i.features), i.quality_model.features)


@query("scored_facilities")
def _(i: Inputs):
    return scoring.score(*i.models, i.features)


@query("scoring_facts", f"""
SELECT provider_id, CAST({scoring.TOP_DRIVERS} AS BIGINT) AS n_drivers, true AS strongest_first, true AS scored FROM features""")
def _(i: Inputs):
    out = scoring.score(*i.models, i.features)
    size = lambda k: F.abs(F.col("top_drivers")[k]["contribution"])
    ordered = [size(k) >= size(k + 1) for k in range(scoring.TOP_DRIVERS - 1)]
    return out.select(KEY, F.size("top_drivers").cast("bigint").alias("n_drivers"), reduce(lambda a, b: a & b, ordered).alias("strongest_first"),
                      (F.col("predicted_risk_label").isNotNull() & F.col("predicted_quality_score").isNotNull()).alias("scored"))


def _sentences(i: Inputs):
    """A sentence per facility and model: its label and the three features that weigh most."""
    labels = i.performance.select(KEY, LABEL)
    tables = dict(zip(("Readmission Risk Classifier", "Quality Score Regressor"), i.models))
    parts = [scoring.explain_text(explain.shap_values(model, i.features).join(labels, KEY), LABEL, model.features, [KEY])
             .select(KEY, F.lit(name).alias("model"), "explanation") for name, model in tables.items()]
    return parts[0].union(parts[1])


@query("risk_explanations")
def _(i: Inputs):
    return _sentences(i)


@query("risk_explanation_facts", f"""
SELECT m.provider_id, model, 'This hospital was flagged ' || coalesce(m.{LABEL}, 'Unknown') || ' primarily because of ' AS beginning,
       CAST(3 AS BIGINT) AS n_features
FROM {M} m JOIN features f ON f.provider_id = m.provider_id
CROSS JOIN (VALUES ('Readmission Risk Classifier'), ('Quality Score Regressor')) models(model)""")
def _(i: Inputs):
    text = F.col("explanation")
    because = " primarily because of "
    return _sentences(i).select(KEY, "model", F.concat(F.substring_index(text, because, 1), F.lit(because)).alias("beginning"),
                                F.size(F.split(F.substring_index(text, because, -1), ", ")).cast("bigint").alias("n_features"))


@query("facility_profiles")
def _(i: Inputs):
    tables = {name: explain.shap_values(model, i.features) for name, model in zip(("shap_classifier", "shap_regressor"), i.models)}
    return joins.profiles(i.performance, tables).select(
        KEY, "hospital_name", "state", LABEL, "shap_classifier", "shap_regressor")


@query("explanations", f"""
SELECT id AS p_partkey, 'This hospital was flagged ' || p_brand || ' primarily because of '
       || string_agg(feature, ', ' ORDER BY place) || '.' AS explanation
FROM ({PLACED}) WHERE place <= 3 GROUP BY id, p_brand""")
def _(i: Inputs):
    return scoring.explain_text(i.table("part"), "p_brand", ["p_size", "p_retailprice", "p_partkey"], ["p_partkey"])
