"""Model training, selection and scoring over ``panel`` and ``visits``; results are model output, so most have no SQL."""
from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelwise.catalog import query
from panelwise.catalog.fixtures import VISITS, rounded, table, visits, vitals_of
from panelwise.operators import learning as L
from panelwise.operators.aggregates import top_features
from panelwise.operators.oversampling import oversample
from panelwise.operators.panel import NUMERIC_COLUMNS
from panelwise.operators.scoring import score_with_model
from panelwise.operators.splits import assign_split
from panelwise.plans.train import train
from panelwise.session import shared_path, write_and_read

_NUMERIC = list(NUMERIC_COLUMNS)
_LABEL = "alzheimers_diagnosis"
_VITALS = ["age", "bmi", "systolic_bp", "diastolic_bp", "glucose", "cholesterol_total", "hdl", "ldl"]


def _split(spark, sf):
    v = visits(spark, sf).select("patient_id", "year", *_NUMERIC, "sex", F.coalesce("education_level", F.lit("unknown")).alias("education_level"), _LABEL)
    return assign_split(v, "patient_id")


@query("i13_train_and_compare")
def _(spark, sf):
    metrics, _, _ = train(_split(spark, sf), "patient_id", _NUMERIC, _LABEL, ["sex", "education_level"])
    return rounded(metrics)


@query("i11_logistic_scores")
def _(spark, sf):
    data = _split(spark, sf)
    model = L.fit_logistic(data.filter("split = 'train'"), _NUMERIC, _LABEL, ["sex"])
    return L.with_score(model, data).select("patient_id", "year", F.round("score", 6).alias("score"), "predicted")


@query("i12_boosted_scores")
def _(spark, sf):
    data = _split(spark, sf)
    model = L.fit_boosted(data.filter("split = 'train'"), _NUMERIC, _LABEL, data.filter("split = 'val'"))
    return L.with_score(model, data).select("patient_id", "year", F.round("score", 6).alias("score"), "predicted")


_SPLIT = f"""{VISITS}, split AS (SELECT *, CASE WHEN u < 2000 THEN 'test' WHEN u < 3600 THEN 'val' ELSE 'train' END AS split
  FROM (SELECT *, CAST('0x' || substr(md5(patient_id || '|42'), 1, 8) AS BIGINT) % 10000 AS u FROM visits))"""
_CATEGORICAL = ["sex", "education_level"]


def _selection(spark, sf, max_features):
    train_rows = _split(spark, sf).filter("split = 'train'")
    return L.select_features(train_rows, _NUMERIC, _LABEL, max_features, categorical=_CATEGORICAL)


@query("i7_feature_selection")
def _(spark, sf):
    """The eight most important of eighteen numeric and two categorical columns, by the importance of all their dummies."""
    kept, report = _selection(spark, sf, 8)
    return rounded(L.selected_features(spark, kept, report))


@query("i15_selection_counts", f"""
WITH {_SPLIT}, t AS (SELECT * REPLACE (coalesce(education_level, 'unknown') AS education_level) FROM split WHERE split = 'train'),
v AS (SELECT {" + ".join(f"CASE WHEN var_pop({c}) > 0.01 THEN 1 ELSE 0 END" for c in _NUMERIC)} AS numeric FROM t),
d AS ({" UNION ALL ".join(f"SELECT '{c}' AS c, count(*) / (SELECT count(*) FROM t)::DOUBLE AS p FROM t GROUP BY {c}" for c in _CATEGORICAL)}),
n AS (SELECT numeric + (SELECT count(DISTINCT c) FROM d WHERE p * (1 - p) > 0.01) AS n FROM v)
SELECT 'variance_threshold' AS item, 0.01::DOUBLE AS value UNION ALL SELECT 'variance_selected', n::DOUBLE FROM n
UNION ALL SELECT 'max_features', 150 UNION ALL SELECT 'final_selected', n::DOUBLE FROM n""")
def _(spark, sf):
    """Counts of a selection that has nothing to cut."""
    return L.selection_report(spark, _selection(spark, sf, L.MAX_FEATURES)[1])


@query("g1_top_features")
def _(spark, sf):
    train_rows = _split(spark, sf).filter("split = 'train'")
    model = L.fit_boosted(train_rows, _NUMERIC, _LABEL, categorical=["sex", "education_level"])
    return rounded(top_features(L.importances(model, train_rows), 5))


_EDUCATIONS = ("Bachelor's", "High School", "Master's", "PhD", "Some College", "unknown")
_DUMMIES_SQL = ", ".join(
    "CAST(CASE WHEN {0} = '{2}' THEN 1 ELSE 0 END AS DOUBLE) AS \"{0}_dummies_{1}\"".format(c, v, v.replace("'", "''")) for c, values in (("sex", "FM"), ("education_level", _EDUCATIONS)) for v in values
)


@query("i4_model_dummies", f"""
WITH {_SPLIT} SELECT patient_id, year, age, {_DUMMIES_SQL}, 0.0::DOUBLE AS sex_dummies___unknown, 0.0::DOUBLE AS education_level_dummies___unknown
FROM (SELECT * REPLACE (coalesce(education_level, 'unknown') AS education_level) FROM split)""")
def _(spark, sf):
    data = _split(spark, sf)
    fitted = Pipeline(stages=L.feature_stages(["age"], _CATEGORICAL)).fit(data.filter("split = 'train'"))
    wide = fitted.transform(data)
    values = vector_to_array("features")
    return wide.select("patient_id", "year", *[values[i].alias(n) for i, n in enumerate(L.vector_names(wide))])


_SLOTS = 5


@query("i4_bounded_dummies", f"""
WITH {_SPLIT}, n AS (SELECT education_level AS v, count(*) AS n FROM (SELECT coalesce(education_level, 'unknown') AS education_level FROM split WHERE split = 'train') GROUP BY 1),
top AS (SELECT v FROM n ORDER BY n DESC, v LIMIT 3), r AS (SELECT coalesce(education_level, 'unknown') IN (SELECT v FROM top) AS known FROM split)
SELECT known, count(*) AS n FROM r GROUP BY known""")
def _(spark, sf):
    """A dictionary of three values; the rows of the others have a hashed dummy."""
    data = _split(spark, sf)
    train_rows = data.filter("split = 'train'")
    dictionaries = L.value_dictionaries(train_rows, ["education_level"], 3)
    fitted = Pipeline(stages=L.feature_stages([], ["education_level"], dictionaries=dictionaries, slots=_SLOTS)).fit(train_rows)
    wide = fitted.transform(data)
    known = [i for i, n in enumerate(L.vector_names(wide)) if "#" not in n and "__unknown" not in n]
    values = vector_to_array("features")
    flag = sum((values[i] for i in known), F.lit(0.0)) > 0
    return wide.groupBy(flag.alias("known")).agg(F.count(F.lit(1)).alias("n"))


def _validated(spark, sf):
    data = write_and_read(_split(spark, sf), "split")  # medians, counts and folds read it
    fills, dictionaries = L.fill_values(data, _NUMERIC, ["sex"]), None
    booster = GBTClassifier(labelCol=_LABEL, seed=42, maxIter=10, maxDepth=3)
    models = {
        "logistic_regression": L.logistic_stages(_NUMERIC, ["sex"], _LABEL, data.count(), None, fills, dictionaries),
        "boosted_trees": [*L.feature_stages(_NUMERIC, ["sex"], fills=fills), booster],
    }
    return L.cross_validate(data, models, "patient_id", _LABEL)


@query("i14_cross_validation")
def _(spark, sf):
    return rounded(_validated(spark, sf).metrics)


@query("i14_held_out_rows", f"""
WITH {VISITS}, f AS (SELECT CAST(CAST('0x' || substr(md5(patient_id || '|42'), 1, 8) AS BIGINT) % 5 AS INTEGER) AS fold, patient_id, {_LABEL} AS label FROM visits)
SELECT m.model, fold, count(*) AS n, count(DISTINCT patient_id) AS entities, CAST(sum(label) AS BIGINT) AS positives
FROM f, (VALUES ('logistic_regression'), ('boosted_trees')) AS m(model) GROUP BY ALL""")
def _(spark, sf):
    """Which rows each model was scored on: each fold once."""
    scored = _validated(spark, sf).scored
    return scored.groupBy("model", "fold").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("patient_id").alias("entities"), F.sum(_LABEL).alias("positives"))


@query("i17_batch_scoring")
def _(spark, sf):
    data = _split(spark, sf)
    model = L.fit_logistic(data.filter("split = 'train'"), _NUMERIC, _LABEL)
    path = shared_path(spark, "model")
    L.save_trained(spark, L.Trained(model, "logistic_regression", _NUMERIC, 0.45), path)
    return rounded(score_with_model(data, L.load_trained(spark, path), keep=("patient_id", "year")))


@query("i17_labels_and_scores", f"WITH {VISITS} SELECT count(*) AS n, CAST(0 AS BIGINT) AS wrong_label, CAST(0 AS BIGINT) AS wrong_report FROM visits")
def _(spark, sf):
    """Rows whose label isn't that of the stored threshold, and whose report isn't that of their score."""
    data = _split(spark, sf)
    model = L.fit_logistic(data.filter("split = 'train'"), _NUMERIC, _LABEL)
    path = shared_path(spark, "model")
    L.save_trained(spark, L.Trained(model, "logistic_regression", _NUMERIC, 0.45), path)
    out = score_with_model(data, L.load_trained(spark, path), keep=("patient_id", "year"))
    wrong = (F.col("label") == 1) != (F.col("score") >= 0.45)
    report = (F.col("prediction") == "High Risk") != (F.col("score") > 0.5)
    return out.agg(F.count(F.lit(1)).alias("n"), F.count_if(wrong).alias("wrong_label"), F.count_if(report).alias("wrong_report"))


@query("i13_confusion_of_splits", f"""
WITH {_SPLIT} SELECT m.model, split, count(*) AS n, CAST(sum({_LABEL}) AS BIGINT) AS positives, CAST(6 AS BIGINT) AS metrics FROM split, (VALUES ('logistic_regression'), ('boosted_trees')) AS m(model) GROUP BY ALL""")
def _(spark, sf):
    """Rows and positives of each split, as a model's metrics (n recomputed from stored scores) have them."""
    data = write_and_read(_split(spark, sf), "split")
    metrics, models = L.compare_models(data, ["age", "bmi", "glucose"], _LABEL, maxIter=5)
    scored = None
    for name, trained in models.items():
        one = L.with_score(trained.model, data).select(F.lit(name).alias("model"), "split", _LABEL)
        scored = one if scored is None else scored.unionByName(one)
    counts = scored.groupBy("model", "split").agg(F.count(F.lit(1)).alias("n"), F.sum(_LABEL).alias("positives"))
    return counts.join(metrics.filter(F.col("value").between(0, 1)).groupBy("model", "split").agg(F.count(F.lit(1)).alias("metrics")), ["model", "split"])


def _oversampled(spark, sf):
    orders = table(spark, sf, "orders")
    positive = orders.select(F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    return oversample(vitals_of(orders).join(positive, "id"), _VITALS, "label")


@query("i10_oversampled_rows")
def _(spark, sf):
    return rounded(_oversampled(spark, sf))


@query("i10_oversampled_classes", """
WITH c AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label, count(*) AS n FROM orders GROUP BY ALL) SELECT label, (SELECT max(n) FROM c) AS n FROM c""")
def _(spark, sf):
    return _oversampled(spark, sf).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
