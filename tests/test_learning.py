import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from panelwise.operators import learning as L
from panelwise.operators.scoring import score_with_model
from panelwise.operators.splits import assign_split
from tests.conftest import rows


@pytest.fixture(scope="module")
def data(spark):
    x = F.col("id") * 37 % 101
    df = spark.range(600).select(
        "id", x.cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("noise"), F.lit(3.0).alias("flat"),
        F.when(F.col("id") % 3 == 0, "u").otherwise("v").alias("c"), ((x + F.col("id") % 5) > 60).cast("int").alias("y"),
    )
    return assign_split(df, "id")


def test_dummies_are_fitted_on_train_only(spark, data):
    fitted = Pipeline(stages=L.feature_stages(["x"], ["c"])).fit(data)
    unseen = fitted.transform(data.limit(1).withColumn("c", F.lit("zz")))
    assert L.vector_names(unseen) == ["x", "c_dummies_u", "c_dummies_v", "c_dummies___unknown"]
    assert list(unseen.first()["features"].toArray()[1:]) == [0.0, 0.0, 1.0]


def test_best_length_has_patience():
    assert L.best_length([3, 2, 1, 2, 2]) == 3
    assert L.best_length([3, 2, 2.5, 2.5, 1], patience=2) == 2
    assert L.best_length([3, 2, 2.5, 2.5, 1], patience=3) == 5


def test_selection(data):
    kept, report = L.select_features(data, ["x", "noise", "flat"], "y", max_features=1)
    assert kept == ["x"] and report["variance_selected"] == 2 and report["final_selected"] == 1


def test_boosted_learns_and_uses_fewer_rounds(data):
    train, val = data.filter("split = 'train'"), data.filter("split = 'val'")
    model = L.fit_boosted(train, ["x", "noise"], "y", val, maxIter=15)
    assert 1 <= model.stages[-1].getNumTrees <= 15
    scored = L.with_score(model, data)
    m = {(r["split"], r["metric"]): r["value"] for r in rows(L.split_metrics(scored, "y"))}
    assert m["test", "roc_auc"] > 0.9 and len(m) == 18


def test_same_seed_same_scores(data):
    train = data.filter("split = 'train'")
    a, b = (L.with_score(L.fit_boosted(train, ["x", "noise"], "y", maxIter=3), data) for _ in range(2))
    assert {r["id"]: r["score"] for r in a.collect()} == {r["id"]: r["score"] for r in b.collect()}


def test_first_trees_are_those_of_a_shorter_fit(spark, data):
    train, params = data.filter("split = 'train'"), {"maxDepth": 3, "seed": 7}
    long, short = (L.fit_boosted(train, ["x", "noise"], "y", maxIter=n, **params) for n in (8, 3))
    cut = L.first_trees(spark, long.stages[-1], 3)
    assert cut.getNumTrees == 3 and cut.treeWeights == short.stages[-1].treeWeights
    ready = PipelineModel(stages=long.stages[:-1]).transform(data)
    scores = lambda m: {r["id"]: r["probability"][1] for r in m.transform(ready).select("id", "probability").collect()}
    assert scores(cut) == scores(short.stages[-1])


def test_early_stopping_fits_once(data, monkeypatch):
    fits = []
    fit = GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, *a, **k: fits.append(1) or fit(self, *a, **k))
    train, val = data.filter("split = 'train'"), data.filter("split = 'val'")
    model = L.fit_boosted(train, ["noise"], "y", val, maxIter=15)
    assert len(fits) == 1 and model.stages[-1].getNumTrees < 15


def test_cross_validation_of_several_models(data):
    booster = GBTClassifier(labelCol="y", maxIter=3, maxDepth=2, seed=1)
    models = {"lr": L.logistic_stages(["x", "noise"], ["c"], "y", 600, None), "trees": [*L.feature_stages(["x", "noise"]), booster]}
    out = L.cross_validate(data, models, "id", "y", folds=3)
    metrics = {(r["model"], r["fold"], r["metric"]): r["value"] for r in out.metrics.collect()}
    assert len(metrics) == 2 * 3 * 6 and min(metrics[m, f, "accuracy"] for m in models for f in range(3)) > 0.85
    held = out.scored.collect()
    assert len(held) == 2 * 600 and len({(r["model"], r["id"]) for r in held}) == 2 * 600
    for name, f in (("lr", 0), ("trees", 2)):
        own = [r for r in held if r["model"] == name and r["fold"] == f]
        assert metrics[name, f, "accuracy"] == pytest.approx(sum(r["predicted"] == r["y"] for r in own) / len(own))
    assert set(out.models) == set(models) and L.with_score(out.models["trees"], data).count() == 600
    with pytest.raises(ValueError):
        L.cross_validate(data.limit(0), models, "id", "y")


def test_compared_models_share_fills_and_vectors(data, monkeypatch):
    calls = []
    for name in ("fill_values", "value_dictionaries", "feature_stages"):
        monkeypatch.setattr(L, name, lambda *a, f=getattr(L, name), n=name, **k: calls.append(n) or f(*a, **k))
    metrics, trained = L.compare_models(data, ["x", "noise"], "y", ["c"], maxIter=3)
    assert sorted(calls) == ["feature_stages", "fill_values", "value_dictionaries"] and metrics.count() == 36
    assert not data.sparkSession.sparkContext._jsc.getPersistentRDDs()
    for t in trained.values():
        assert L.with_score(t.model, data).count() == data.count()


def test_folds_share_stored_features(data, monkeypatch):
    """No fold reads all rows for its labels or its vectors; a value of one fold alone has no dummy where that fold is held out."""
    monkeypatch.setattr(StringIndexer, "fit", lambda *_: pytest.fail("an indexer is fitted"))
    stored = []
    write = L._write_folds
    monkeypatch.setattr(L, "_write_folds", lambda df, name: stored.append(name) or write(df, name))
    booster = GBTClassifier(labelCol="y", maxIter=2, maxDepth=2, seed=1)
    models = {"lr": L.logistic_stages(["x"], ["c"], "y", 600, None), "trees": [*L.feature_stages(["x"], ["c"], fills={"x": 0.0, "c": "u"}), booster]}
    out = L.cross_validate(data, models, "id", "y", folds=3)
    assert stored == ["folds", "fold-features", "fold-features"] and out.scored.count() == 1200
    assert L.vector_names(L.PipelineModel(out.models["trees"].stages[:-1]).transform(data)) == ["x", "c_dummies_u", "c_dummies_v", "c_dummies___unknown"]
    ready = data.withColumn("_fold", (F.col("id") % 3).cast("int")).withColumn("k", F.when(F.col("_fold") == 1, "only").when(F.col("_fold") == 0, "u"))
    labels = L._fold_labels(ready, [], StringIndexer(inputCols=["k"], outputCols=["i"], stringOrderType="alphabetAsc"), [0, 1, 2])
    assert labels == {0: (("only",),), 1: (("u",),), 2: (("only", "u"),), None: (("only", "u"),)}


def test_fits_keep_few_rows_a_task(data, monkeypatch):
    """A table of one task is fitted in tasks of bounded size, and then fewer fits run at a time; results are the same."""
    one = data.coalesce(1)
    models = {"trees": [*L.feature_stages(["x"]), GBTClassifier(labelCol="y", maxIter=2, maxDepth=2, seed=1)]}

    def run():
        return {(r["model"], r["fold"], r["metric"]): r["value"] for r in L.cross_validate(one, models, "id", "y", folds=2).metrics.collect()}

    whole = run()
    pools, pool = [], L.ThreadPoolExecutor
    monkeypatch.setattr(L, "ThreadPoolExecutor", lambda n: pools.append(n) or pool(n))
    monkeypatch.setattr(L, "FIT_ROWS", 40)
    limit = data.sparkSession.conf.get("spark.sql.files.maxPartitionBytes")
    table = L._write_folds(one.withColumn("_fold", (F.col("id") % 3).cast("int")), "few")
    each = [r["count"] for r in table.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(each) == 600 and max(each) <= 80
    assert run() == pytest.approx(whole) and pools == [1]
    assert data.sparkSession.conf.get("spark.sql.files.maxPartitionBytes") == limit


def test_values_beyond_the_dictionary_share_hashed_dummies(spark):
    df = spark.range(400).select((F.col("id") % 2).cast("int").alias("y"), F.concat(F.lit("v'"), F.least(F.col("id") % 40, F.lit(39)).cast("string")).alias("c"))
    df = df.unionByName(spark.createDataFrame([(1, "v'0"), (0, None)], "y int, c string"))
    kept = L.value_dictionaries(df, ["c"], 10)
    assert len(kept["c"]) == 10 and kept["c"][0] == "v'0" and L.value_dictionaries(df, ["c"], 40) == {}
    fitted = Pipeline(stages=L.feature_stages([], ["c"], dictionaries=kept, slots=4)).fit(df)
    wide = fitted.transform(df)
    names = L.vector_names(wide)
    assert len(names) <= 10 + 4 + 1 and {"c_known" in n or "c_dummies" in n for n in names} == {True}
    for r in wide.collect():
        assert sum(r["features"].toArray()) == 1.0
    filled = Pipeline(stages=L.feature_stages([], ["c"], fills={"c": "v'0"}, dictionaries=kept, slots=4)).fit(df).transform(df)
    assert filled.filter("c IS NULL").first()["features"] == filled.filter(F.col("c") == "v'0").first()["features"]


def test_selection_over_dummies(spark, data):
    wide = data.withColumn("k", F.when(F.col("y") == 1, "hit").otherwise("miss")).withColumn("same", F.lit("s"))
    kept, report = L.select_features(wide, ["noise", "flat"], "y", max_features=1, categorical=["c", "k", "same"])
    assert kept == ["k"] and report["variance_selected"] == 3 and list(report["importance"]) == ["k"]
    assert [tuple(r)[:2] for r in L.selected_features(spark, kept, report).collect()] == [(1, "k")]
    found = spark.createDataFrame([("c_dummies_a", 0.2), ("c_dummies_b", 0.1), ("c_dummies_x_dummies_a", 0.3), ("n", 0.4)], "feature string, importance double")
    got = {r[0]: round(r[1], 6) for r in L.importances_by_column(found, ["n"], ["c", "c_dummies_x"]).collect()}
    assert got == {"c": 0.3, "c_dummies_x": 0.3, "n": 0.4}
    assert L.rank_categorical(wide, ["same", "c", "k"], 2) == ["c", "k"]


def test_stored_model_scores_with_missing_and_extra_columns(spark, data, tmp_path):
    model = L.fit_logistic(data, ["x", "noise"], "y")
    L.save_trained(spark, L.Trained(model, "logistic_regression", ["x", "noise"], 0.3), str(tmp_path / "m"))
    loaded = L.load_trained(spark, str(tmp_path / "m"))
    out = rows(score_with_model(data.drop("noise"), loaded, keep=("id",)), "id")
    want = rows(score_with_model(data.withColumn("noise", F.lit(0.0)), loaded, keep=("id",)), "id")
    assert out == want
    assert all(r["label"] == int(r["score"] >= 0.3) for r in out)


@pytest.mark.parametrize("imbalance", ["oversample", "none"])
def test_imbalance_options(data, imbalance):
    metrics, trained = L.train_models(data, ["x", "noise"], "y", imbalance=imbalance, maxIter=3)
    assert metrics.count() == 36 and trained.name == "boosted_trees"
    with pytest.raises(ValueError):
        L.train_models(data, ["x"], "y", ["c"], imbalance="oversample")
