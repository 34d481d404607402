"""Feature table to trained model: split, select, fit, compare, store, register."""
from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.operators.learning import CHOSEN, MAX_FEATURES, Trained, compare_models, load_trained, save_trained, select_features
from panelwise.operators.scaling import uncertainty_columns
from panelwise.operators.splits import SEED, assign_split
from panelwise.session import write_and_read
from panelwise.sources.registry import history, read_registry, register, specific, with_version


def train_all(
    df: DataFrame, entity: str, numeric: Sequence[str], label: str, categorical: Sequence[str] = (), seed: int = SEED, uncertainty: bool = False, period: str = "year", age: str = "age", max_features: int = MAX_FEATURES, **options
) -> tuple[DataFrame, dict[str, Trained], dict]:
    """(metrics per model and split, models by name, selection report); ``options`` go to ``compare_models``.

    With ``uncertainty``, ``diagnostic_confidence`` and ``cumulative_risk_factor`` join the numeric features, from ``period`` if the frame
    has it. Numeric and categorical columns are selected together. The split table is stored once, since fitting
    and evaluation read it many times.
    """
    if uncertainty:
        df = uncertainty_columns(df, age, period)
        numeric = [*numeric, "diagnostic_confidence", "cumulative_risk_factor"]
    ready = write_and_read(assign_split(df, entity, seed=seed).select(entity, label, "split", *numeric, *categorical), "training")
    kept, report = select_features(ready.filter(F.col("split") == "train"), numeric, label, max_features, seed=seed, categorical=categorical)
    used = [c for c in kept if c not in categorical], [c for c in kept if c in categorical]
    metrics, trained = compare_models(ready, used[0], label, used[1], seed=seed, **options)
    return metrics, trained, report


def train(df: DataFrame, entity: str, numeric: Sequence[str], label: str, categorical: Sequence[str] = (), **options) -> tuple[DataFrame, Trained, dict]:
    """The same with the chosen model only."""
    metrics, trained, report = train_all(df, entity, numeric, label, categorical, **options)
    return metrics, trained[CHOSEN], report


def train_and_register(df: DataFrame, entity: str, numeric: Sequence[str], label: str, store: str, name: str, **kw) -> DataFrame:
    """Train, save the chosen model below its version in ``store`` and the others beside it, and add its metrics to the
    registry; returns all metrics."""
    spark = df.sparkSession
    started = datetime.now(timezone.utc)
    metrics, models, report = train_all(df, entity, numeric, label, **kw)
    trained = models[CHOSEN]
    chosen = {(r["split"], r["metric"]): r["value"] for r in metrics.filter(F.col("model") == trained.name).collect()}
    kinds = {"accuracy": "accuracy", "f1": "f1", "auc": "roc_auc"}
    row = {f"{s}_{short}": chosen.get((s, metric)) for s in ("train", "val", "test") for short, metric in kinds.items()}
    row |= {
        "model_name": name,
        "model_type": trained.name,
        "created_at": started.isoformat(),
        "feature_count": len(trained.features),
        "target_column": label,
        "optimal_threshold": float(trained.threshold),
        "training_duration": (datetime.now(timezone.utc) - started).total_seconds(),
    }
    schema = ", ".join(
        f"{k} {'int' if isinstance(v, int) else 'string' if isinstance(v, str) else 'double'}" for k, v in row.items()
    )
    entry = spark.createDataFrame([tuple(row.values())], schema)
    entry = entry.withColumn("feature_names", F.array(*[F.lit(f) for f in trained.features]))
    entry = with_version(entry)
    made = entry.select("version", "model_path").first()
    for other, model in models.items():  # first the models, then the row that points to them
        path = f"{store}/{made['model_path']}"
        save_trained(spark, model, path if other == CHOSEN else f"{path}_{other}")
    register(entry.withColumn("version", F.lit(made["version"])), f"{store}/registry")
    return metrics


def load_version(spark: SparkSession, store: str, name: str, version: str | None = None, other: str | None = None) -> Trained:
    """A registered model: the named version, or the newest; ``other`` names a model trained beside it. ValueError if there is
    no such version."""
    versions = read_registry(spark, f"{store}/registry").filter(F.col("model_name") == name)
    row = (specific(versions, name, version) if version else history(versions, name)).first()
    if row is None:
        raise ValueError(f"no version of {name}")
    return load_trained(spark, f"{store}/{row['model_path']}{f'_{other}' if other else ''}")
