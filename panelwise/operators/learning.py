"""Training, comparison and storage of binary classifiers with Spark ML."""
from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack, contextmanager
from functools import partial, reduce
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.operators.aggregates import top_cardinality, top_features
from panelwise.operators.evaluation import COARSE_THRESHOLDS, _metrics, best_f1_threshold, ranking_metrics, threshold_sweep
from panelwise.operators.encoding import top_values
from panelwise.operators.oversampling import oversample
from panelwise.operators.ranking import exact_quantiles
from panelwise.operators.scaling import VARIANCE_THRESHOLD, varying_columns
from panelwise.operators.skew import col
from panelwise.operators.splits import SEED, fold_of, positive_weight, with_class_weight
from panelwise.session import shared_path, write_and_read

MAX_FEATURES = 150
# fixed values
BOOSTED = {"maxIter": 50, "maxDepth": 4, "stepSize": 0.2, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}
SELECTOR = {"maxIter": 25, "maxDepth": 3, "stepSize": 0.3}
PATIENCE = 10
MAX_CATEGORICAL = 50
# -----
#: Values of a categorical column that get a dummy each; the others share ``VALUE_SLOTS`` dummies by hash.
MAX_VALUES, VALUE_SLOTS = 1000, 64
FILLED = "_filled"
#: Rows of a task that fits. Spark ML keeps what a task has read, so this bounds the blocks that executors keep, spill and send.
FIT_ROWS = 200_000


class Trained(NamedTuple):
    model: PipelineModel
    name: str
    features: list[str]
    threshold: float


def fill_values(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()) -> dict[str, float | str]:
    """Exact median of each numeric column and most frequent value of each categorical one (ties by value), of the training
    rows; 0 and "unknown" for a column without values."""
    medians = {r["name"]: r["m"] for r in exact_quantiles(train, numeric, {"m": 0.5}).collect()} if numeric else {}
    modes = {c: r[0] for c in categorical if (r := top_values(train, c, 1).select(col(c)).first())}
    return {**{c: medians.get(c, 0.0) for c in numeric}, **{c: modes.get(c, "unknown") for c in categorical}}


def value_dictionaries(train: DataFrame, categorical: Sequence[str], limit: int = MAX_VALUES) -> dict[str, list[str]]:
    """The ``limit`` most frequent values (ties by value) of each column that has more than that; others need none.

    At most ``limit`` + 1 values of a column reach the driver.
    """
    out = {}
    for c in categorical:
        found = [r[0] for r in top_values(train, c, limit + 1).select(col(c).cast("string")).collect()]
        if len(found) > limit:
            out[c] = found[:limit]
    return out


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def feature_stages(
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    out: str = "features",
    fills: Mapping[str, float | str] | None = None,
    dictionaries: Mapping[str, Sequence[str]] | None = None,
    slots: int = VALUE_SLOTS,
) -> list:
    """Missing values filled with ``fills``, an assembler over the numeric columns, and one dummy per category; unseen
    categories get a slot of their own.

    Values that the dictionary of a column (``value_dictionaries``) lacks become one of ``slots`` values ``#0``, ``#1`` and so
    on, by hash, so neither the labels nor the vector grow with the data. Fitted on the training split only, so all splits
    share the same columns. Fills and dictionaries are part of the stored model.
    """
    index = [f"{c}_index" for c in categorical]
    dummies = [f"{c}_dummies" for c in categorical]
    stages: list = []
    if fills is not None:
        filled = [f"coalesce(nullif(cast(`{c}` as double), double('NaN')), double('{fills[c]!r}')) AS `{c}{FILLED}`" for c in numeric]
        filled += [f"coalesce(`{c}`, {_quoted(str(fills[c]))}) AS `{c}{FILLED}`" for c in categorical]
        stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(filled)} FROM __THIS__"))
        dictionaries = {f"{c}{FILLED}": v for c, v in (dictionaries or {}).items()}
        numeric, categorical = [f"{c}{FILLED}" for c in numeric], [f"{c}{FILLED}" for c in categorical]
    bounded = {c: f"{c}_known" for c in categorical if c in (dictionaries or {})}
    if bounded:
        known = [f"CASE WHEN `{c}` IN ({', '.join(map(_quoted, dictionaries[c]))}) THEN `{c}` WHEN `{c}` IS NOT NULL THEN concat('#', pmod(xxhash64(`{c}`), {int(slots)})) END AS `{k}`" for c, k in bounded.items()]
        stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(known)} FROM __THIS__"))
        categorical = [bounded.get(c, c) for c in categorical]
    if categorical:
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=index, stringOrderType="alphabetAsc", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=index, outputCols=dummies, dropLast=False))
    stages.append(VectorAssembler(inputCols=[*numeric, *dummies], outputCol=out, handleInvalid="error"))
    return stages


def vector_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector's slots, from the column's ML attributes."""
    groups = df.schema[column].metadata["ml_attr"]["attrs"].values()
    return [a["name"].removesuffix(FILLED) for a in sorted((a for g in groups for a in g), key=lambda a: a["idx"])]


def importances(model: PipelineModel, sample: DataFrame) -> DataFrame:
    """Rows (feature, importance) of the last stage; only the schema of ``sample`` is used."""
    names = vector_names(PipelineModel(model.stages[:-1]).transform(sample))
    rows = list(zip(names, [float(x) for x in model.stages[-1].featureImportances.toArray()]))
    return sample.sparkSession.createDataFrame(rows, "feature string, importance double")


def rank_categorical(df: DataFrame, columns: Sequence[str], k: int = MAX_CATEGORICAL) -> list[str]:
    """The ``k`` columns with most values by HyperLogLog counts, in frame order; all if there are no more."""
    if len(columns) <= k:
        return list(columns)
    kept = {r["column"] for r in top_cardinality(df, columns, k, approximate=True).collect()}
    return [c for c in columns if c in kept]


def varying_categorical(df: DataFrame, columns: Sequence[str], threshold: float = VARIANCE_THRESHOLD) -> list[str]:
    """Columns one of whose dummies varies more than the threshold: the dummy of a share p has variance p (1 - p)."""
    if not columns:
        return []
    total = df.count()
    cells = [F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in columns]
    counts = df.select(F.inline(F.array(*cells))).filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.lit(max(total, 1))
    kept = {r[0] for r in counts.filter(share * (1 - share) > threshold).select("column").distinct().collect()}
    return [c for c in columns if c in kept]


def importances_by_column(found: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Importances of a vector's slots added up by the column that a slot stems from."""
    owner = F.col("feature")
    for c in sorted(categorical, key=len):  # of two prefixes the longer wins
        dummy = F.col("feature").startswith(f"{c}_dummies_") & ~F.col("feature").isin(list(numeric))
        owner = F.when(dummy, F.lit(c)).otherwise(owner)
    return found.groupBy(owner.alias("feature")).agg(F.sum("importance").alias("importance"))


def select_features(
    train: DataFrame,
    numeric: Sequence[str],
    label: str,
    max_features: int = MAX_FEATURES,
    threshold: float = VARIANCE_THRESHOLD,
    seed: int = SEED,
    categorical: Sequence[str] = (),
) -> tuple[list[str], dict]:
    """Columns that vary, cut to the most important by a small boosted model if there are more than ``max_features``.

    Categorical columns (the ``MAX_CATEGORICAL`` of most values) count by their dummies: one varies if a dummy does, and its
    importance is that of all its dummies. Returns the columns, most important first if cut, and a report: the counts of
    the selection and, if cut, ``importance`` of each column.
    """
    ranked = rank_categorical(train, categorical)
    kept_numeric, kept_categorical = varying_columns(train, numeric, threshold), varying_categorical(train, ranked, threshold)
    kept = [*kept_numeric, *kept_categorical]
    report: dict = {"variance_threshold": threshold, "variance_selected": len(kept)}
    if len(kept) > max_features:
        booster = GBTClassifier(labelCol=label, seed=seed, **SELECTOR)
        stages = feature_stages(kept_numeric, kept_categorical, fills=fill_values(train, kept_numeric, kept_categorical), dictionaries=value_dictionaries(train, kept_categorical))
        model = Pipeline(stages=[*stages, booster]).fit(train)
        found = importances_by_column(importances(model, train), kept_numeric, kept_categorical)
        top = top_features(found, max_features).collect()
        kept = [r["feature"] for r in top]
        report["importance"] = {r["feature"]: r["importance"] for r in top}
    return kept, {**report, "max_features": max_features, "final_selected": len(kept)}


def selection_report(spark: SparkSession, report: Mapping[str, float]) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in report.items() if not isinstance(v, Mapping)], "item string, value double")


def selected_features(spark: SparkSession, kept: Sequence[str], report: Mapping) -> DataFrame:
    """Rows (place, feature, importance) of a selection; importance is null if nothing was cut."""
    weights = report.get("importance", {})
    return spark.createDataFrame([(i + 1, c, weights.get(c)) for i, c in enumerate(kept)], "place int, feature string, importance double")


def _scaled_logistic(label: str, rows: int, weight: str | None) -> list:
    """Scaled features, then logistic regression with L2 strength C = 1, i.e. 1/n on the mean loss.

    The scaler divides by the sample deviation. The penalty is lowered by (n - 1)/n, which gives exactly the model of
    features scaled by the population deviation.
    """
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    n = max(rows, 1)
    lr = LogisticRegression(labelCol=label, regParam=max(n - 1, 1) / n / n, standardization=False, maxIter=500, tol=1e-3)
    return [scaler, lr.setWeightCol(weight) if weight else lr]


def logistic_stages(
    numeric: Sequence[str],
    categorical: Sequence[str],
    label: str,
    rows: int,
    weight: str | None,
    fills: Mapping[str, float | str] | None = None,
    dictionaries: Mapping[str, Sequence[str]] | None = None,
) -> list:
    """Feature stages, scaler and logistic regression."""
    return [*feature_stages(numeric, categorical, "raw_features", fills, dictionaries), *_scaled_logistic(label, rows, weight)]


def fit_features(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()) -> PipelineModel:
    """The feature stages with the fills and dictionaries of the training rows."""
    fills, dictionaries = fill_values(train, numeric, categorical), value_dictionaries(train, categorical)
    return Pipeline(stages=feature_stages(numeric, categorical, fills=fills, dictionaries=dictionaries)).fit(train)


@contextmanager
def _vectors(prepared: PipelineModel, df: DataFrame, *columns: str):
    """The columns and ``features`` of the rows, made once for all that reads them; partitions and order are those of the rows."""
    out = prepared.transform(df).select(*[col(c) for c in columns], "features").persist()
    try:
        yield out
    finally:
        out.unpersist()


def _raw(vectors: DataFrame) -> DataFrame:
    return vectors.withColumnRenamed("features", "raw_features")


def _whole(prepared: PipelineModel, model: PipelineModel) -> PipelineModel:
    """A logistic model of vectors, after the stages that make them."""
    last = prepared.stages[-1]
    return PipelineModel([*prepared.stages[:-1], last.copy({last.outputCol: "raw_features"}), *model.stages])


def _logistic_of(vectors: DataFrame, label: str, balanced: bool) -> PipelineModel:
    raw = _raw(vectors)
    data = with_class_weight(raw, label) if balanced else raw
    return Pipeline(stages=_scaled_logistic(label, vectors.count(), "weight" if balanced else None)).fit(data)


def fit_logistic(train: DataFrame, numeric: Sequence[str], label: str, categorical: Sequence[str] = (), balanced: bool = True) -> PipelineModel:
    prepared = fit_features(train, numeric, categorical)
    return _whole(prepared, _logistic_of(prepared.transform(train), label, balanced))


def best_length(losses: Sequence[float], patience: int = PATIENCE) -> int:
    """Number of rounds up to the best loss, looking no further than ``patience`` rounds without a better one."""
    best, at = float("inf"), 0
    for i, loss in enumerate(losses):
        if loss < best:
            best, at = loss, i
        elif i - at >= patience:
            break
    return at + 1


def first_trees(spark: SparkSession, model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The ensemble of the first ``n`` trees. Each tree corrects those before it, so this is what ``n`` rounds would have fitted.

    The model is stored, its tables are filtered by tree and read back as a model.
    """
    whole, cut = shared_path(spark, "trees"), shared_path(spark, "first-trees")
    model.write().save(whole)
    for part in ("data", "treesMetadata"):  # the tree's number is the first column of both
        rows = spark.read.parquet(f"{whole}/{part}")
        rows.filter(col(rows.columns[0]) < n).write.parquet(f"{cut}/{part}")
    about = json.loads(spark.read.text(f"{whole}/metadata").first()[0])
    about["numTrees"] = about["paramMap"]["maxIter"] = n
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{cut}/metadata")
    return GBTClassificationModel.load(cut)


def _boosted_of(vectors: DataFrame, label: str, val: DataFrame | None, balanced: bool, seed: int, **params) -> GBTClassificationModel:
    data = vectors
    if balanced:
        data = vectors.withColumn("weight", F.when(col(label) == 1, F.lit(positive_weight(vectors, label))).otherwise(F.lit(1.0)))
    settings = {**BOOSTED, **params}
    booster = GBTClassifier(labelCol=label, seed=seed, **settings)
    if balanced:
        booster = booster.setWeightCol("weight")
    model = booster.fit(data)
    if val is not None:
        seen = val.withColumn("weight", F.lit(1.0)) if balanced else val
        rounds = best_length(model.evaluateEachIteration(seen.withColumn(label, col(label).cast("double"))))
        if rounds < settings["maxIter"]:
            model = first_trees(vectors.sparkSession, model, rounds)
    return model


def fit_boosted(
    train: DataFrame,
    numeric: Sequence[str],
    label: str,
    val: DataFrame | None = None,
    categorical: Sequence[str] = (),
    balanced: bool = True,
    seed: int = SEED,
    **params,
) -> PipelineModel:
    """Gradient-boosted trees, positives weighted by the class ratio.

    With a validation split all rounds are fitted, the best number of rounds is found on ``val`` and the later trees go.
    """
    prepared = fit_features(train, numeric, categorical)
    seen = None if val is None else prepared.transform(val)
    return PipelineModel(stages=[*prepared.stages, _boosted_of(prepared.transform(train), label, seen, balanced, seed, **params)])


def with_score(model: PipelineModel, df: DataFrame, out: str = "score") -> DataFrame:
    """The frame with the positive-class probability and the model's own 0/1 prediction; helper columns dropped."""
    scored = model.transform(df)
    return scored.select(
        *[col(c) for c in df.columns], vector_to_array("probability")[1].alias(out), F.col("prediction").cast("int").alias("predicted")
    )


def split_metrics(scored: DataFrame, label: str, group: str = "split", score: str = "score") -> DataFrame:
    """Rows (split, metric, value): accuracy, precision, recall, f1 at the model's own cut, AUC and AP on scores."""
    y, p = col(label) == 1, F.col("predicted") == 1
    counts = scored.groupBy(col(group)).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn")
    )
    at_cut = counts.select(col(group), *[m.alias(n) for n, m in _metrics(*[F.col(c) for c in ("tp", "fp", "fn", "tn")]).items()])
    ranked = ranking_metrics(scored, label, score, [group]).withColumnsRenamed({"auc": "roc_auc", "average_precision": "pr_auc"})
    wide = at_cut.join(ranked, group)
    metrics = ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics]
    return wide.select(col(group), F.inline(F.array(*cells)))


def compare_models(
    df: DataFrame,
    numeric: Sequence[str],
    label: str,
    categorical: Sequence[str] = (),
    split: str = "split",
    imbalance: str = "class_weight",
    seed: int = SEED,
    **boosted,
) -> tuple[DataFrame, dict[str, Trained]]:
    """Fit logistic regression and boosted trees on the train split.

    ``imbalance`` is class_weight, oversample (synthetic minority rows in the train split, numeric columns only) or
    none.

    Returns the metrics (model, split, metric, value) of all splits and the models by name, each with the threshold of the
    best F1 on the validation split.
    """
    train = df.filter(col(split) == "train")
    balanced = imbalance == "class_weight"
    if imbalance == "oversample":
        if categorical:
            raise ValueError("encode categorical columns before oversampling")
        train = write_and_read(oversample(train, numeric, label, seed=seed), "oversampled")
    elif imbalance not in ("class_weight", "none"):
        raise ValueError(f"unknown imbalance method {imbalance!r}")
    prepared = fit_features(train, numeric, categorical)
    tables, thresholds = [], {}
    with _vectors(prepared, df, split, label) as vectors, ExitStack() as more:
        own = more.enter_context(_vectors(prepared, train, label)) if imbalance == "oversample" else vectors.filter(col(split) == "train")
        logistic = _logistic_of(own, label, balanced)
        boosted_trees = _boosted_of(own, label, vectors.filter(col(split) == "val"), balanced, seed, **boosted)
        models = {"logistic_regression": _whole(prepared, logistic), "boosted_trees": PipelineModel([*prepared.stages, boosted_trees])}
        for name, model, rows in (("logistic_regression", logistic, _raw(vectors)), ("boosted_trees", boosted_trees, vectors)):
            scored = write_and_read(with_score(model, rows).select(col(split), col(label), "score", "predicted"), "scores")
            tables.append(split_metrics(scored, label, split).select(F.lit(name).alias("model"), col(split).alias("split"), "metric", "value"))
            sweep = threshold_sweep(scored.filter(col(split) == "val"), label, "score", COARSE_THRESHOLDS)
            thresholds[name] = best_f1_threshold(sweep).first()["threshold"]
    trained = {name: Trained(model, name, [*numeric, *categorical], thresholds[name]) for name, model in models.items()}
    return tables[0].unionByName(tables[1]), trained


#: The model to use of those that are compared.
CHOSEN = "boosted_trees"


def train_models(df: DataFrame, numeric: Sequence[str], label: str, categorical: Sequence[str] = (), **options) -> tuple[DataFrame, Trained]:
    """The metrics of ``compare_models`` and the model to use."""
    metrics, trained = compare_models(df, numeric, label, categorical, **options)
    return metrics, trained[CHOSEN]


class Validated(NamedTuple):
    metrics: DataFrame
    scored: DataFrame
    models: dict[str, PipelineModel]


def _needed(frame: DataFrame, stages: Sequence, *more: str) -> DataFrame:
    """The columns of ``frame`` that parameters of the stages name, and ``more``."""
    named = set(more)
    for stage in stages:
        for p in stage.params:
            value = stage.getOrDefault(p) if stage.isDefined(p) else None
            named |= {x for x in (value if isinstance(value, list) else [value]) if isinstance(x, str)}
    return frame.select(*[col(c) for c in frame.columns if c in named])


def _leading(stages: Sequence) -> tuple[list, StringIndexer | None, list, list]:
    """The stages of a pipeline as those before its indexer, the indexer, those that depend on its labels alone, and the others."""
    left, before, after, indexer = list(stages), [], [], None
    while left and isinstance(left[0], SQLTransformer):
        before.append(left.pop(0))
    if left and isinstance(left[0], StringIndexer) and left[0].isSet("inputCols") and left[0].getStringOrderType() == "alphabetAsc":
        indexer = left.pop(0)
    while left and isinstance(left[0], (OneHotEncoder, VectorAssembler) if indexer else VectorAssembler):
        after.append(left.pop(0))
    return (before, indexer, after, left) if left else ([], None, [], list(stages))


def _fold_labels(ready: DataFrame, before: Sequence, indexer: StringIndexer | None, folds: Sequence[int]) -> dict[int | None, tuple]:
    """The labels of each of the indexer's columns as fitted without each fold, and without none."""
    if indexer is None:
        return {f: () for f in [*folds, None]}
    cells = [F.struct(F.lit(i).alias("at"), col(c).cast("string").alias("value")) for i, c in enumerate(indexer.getInputCols())]
    seen = PipelineModel(list(before)).transform(ready).select("_fold", F.inline(F.array(*cells))).filter(F.col("value").isNotNull())
    found = seen.distinct().collect()  # what the indexers of all folds would collect
    order = lambda x: x.encode("utf-16-be", "surrogatepass")
    return {
        f: tuple(tuple(sorted({r["value"] for r in found if r["at"] == i and r["_fold"] != f}, key=order)) for i in range(len(cells)))
        for f in [*folds, None]
    }


class _Prepared(NamedTuple):
    stages: list
    rest: list
    table: DataFrame


def _prepared(ready: DataFrame, stages: Sequence, folds: Sequence[int], keep: Sequence[str]) -> dict[int | None, _Prepared]:
    """For each fold the leading stages as fitted without it, the stages left to fit, and the stored table for these.

    The labels of all folds come from one aggregate. Folds of the same labels share one table of feature vectors.
    """
    before, indexer, after, rest = _leading(stages)
    labels = _fold_labels(ready, before, indexer, folds)
    if not all(all(x) for x in labels.values()):  # a column without values: all stages are left to fit
        before, indexer, after, rest, labels = [], None, [], list(stages), {f: () for f in labels}
    made: dict[tuple, _Prepared] = {}
    for found in labels.values():
        if found in made:
            continue
        known = []
        if indexer is not None:
            known = [StringIndexerModel.from_arrays_of_labels([list(x) for x in found], indexer.getInputCols(), indexer.getOutputCols(), indexer.getHandleInvalid())]
        fitted = Pipeline(stages=[*before, *known, *after]).fit(ready)
        table = ready
        if fitted.stages:
            table = _write_folds(_needed(fitted.transform(ready), rest, "_fold", *keep), "fold-features")
        made[found] = _Prepared(fitted.stages, rest, table)
    return {f: made[found] for f, found in labels.items()}


def _write_folds(df: DataFrame, name: str) -> DataFrame:
    """As ``write_and_read``, with a folder for each fold. A task that reads the table gets about ``FIT_ROWS`` rows at most."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.partitionBy("_fold").option("compression", "zstd").option("maxRecordsPerFile", FIT_ROWS).parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    rows = spark.read.schema(df.schema).parquet(path).count()
    own = spark.newSession()  # the limits hold for reads of this table alone
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.files.maxPartitionBytes", str(max(1, size * FIT_ROWS // max(1, rows))))
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    return own.read.schema(df.schema).parquet(path)


def _side_by_side(tables: Sequence[DataFrame], parallelism: int) -> int:
    """Fits that share the cluster at a time: fewer if the tasks of one keep it busy, as each keeps its own rows until it ends."""
    tasks = max(t._jdf.queryExecution().toRdd().getNumPartitions() for t in tables)
    return max(1, min(parallelism, parallelism * tables[0].sparkSession.sparkContext.defaultParallelism // max(1, tasks)))


def cross_validate(
    df: DataFrame, models: Mapping[str, Sequence], entity: str, label: str, folds: int = 5, parallelism: int = 4, seed: int = SEED
) -> Validated:
    """Each of ``models`` (name: pipeline stages) fitted without each fold of entities, scored on it, and fitted on all rows.

    ``metrics`` has rows (model, fold, metric, value), ``scored`` the held-out rows (model, fold, entity, label, score,
    predicted), ``models`` the models of all rows. The table is stored once with its folds, and so are the feature vectors of
    each model, which its fits and scores read, ``FIT_ROWS`` a task. Up to ``parallelism`` fits share the cluster at a time, one
    where its tasks are several times the cluster's cores. A fold without rows has no metrics.
    """
    ready = _write_folds(df.withColumn("_fold", fold_of(entity, folds, seed)), "folds")
    present = sorted(r[0] for r in ready.select("_fold").distinct().collect())  # folds at most
    if not present:
        raise ValueError("no rows to validate on")
    prepared = {name: _prepared(ready, stages, present, (entity, label)) for name, stages in models.items()}
    jobs = [(name, fold) for name in models for fold in [*present, None]]

    def fit(name: str, fold: int | None) -> PipelineModel:
        _, rest, table = prepared[name][fold]
        return Pipeline(stages=rest).fit(table if fold is None else table.filter(F.col("_fold") != fold))

    with ThreadPoolExecutor(_side_by_side([p.table for of in prepared.values() for p in of.values()], parallelism)) as pool:
        started = [pool.submit(inheritable_thread_target(df.sparkSession)(partial(fit, *job))) for job in jobs]
        fitted = {job: s.result() for job, s in zip(jobs, started)}
    parts = []
    for (name, fold), model in fitted.items():
        if fold is not None:
            held = with_score(model, prepared[name][fold].table.filter(F.col("_fold") == fold))
            parts.append(held.select(F.lit(name).alias("model"), F.col("_fold").alias("fold"), col(entity), col(label), "score", "predicted"))
    scored = write_and_read(reduce(DataFrame.unionByName, parts), "held-out-scores")
    keyed = scored.withColumn("_key", F.concat_ws("\n", "model", "fold"))
    metrics = split_metrics(keyed, label, "_key").select(
        F.split("_key", "\n")[0].alias("model"), F.split("_key", "\n")[1].cast("int").alias("fold"), "metric", "value"
    )
    whole = {name: PipelineModel([*prepared[name][None].stages, *fitted[name, None].stages]) for name in models}
    return Validated(metrics, scored, whole)


def save_trained(spark: SparkSession, trained: Trained, path: str) -> None:
    """Model, feature list and threshold below ``path``."""
    trained.model.write().overwrite().save(f"{path}/model")
    about = json.dumps({"name": trained.name, "feature_names": trained.features, "optimal_threshold": trained.threshold})
    spark.createDataFrame([(about,)], "value string").write.mode("overwrite").text(f"{path}/about")


def load_trained(spark: SparkSession, path: str) -> Trained:
    about = json.loads(spark.read.text(f"{path}/about").first()[0])
    return Trained(PipelineModel.load(f"{path}/model"), about["name"], about["feature_names"], about["optimal_threshold"])
