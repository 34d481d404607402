"""Model registry: one row per model version, stored as Parquet snapshots.

A plain Parquet table cannot be overwritten while it is read, so each registration writes a new snapshot folder. It becomes
visible by a marker, a small file ``commits/<number>`` that names the folder; readers follow the highest marker and never see a
folder without one. A marker is written aside and renamed to its number, which fails if the number is taken: then
the writer reads what was committed and tries again on top of it.
"""
from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwise.functions.identity import version_key

KEEP = 10
FIELDS = (
    "model_name string, model_type string, version string, created_at string, training_date string, "
    "training_duration double, random_seed int, training_samples bigint, validation_samples bigint, "
    "test_samples bigint, feature_count int, target_column string, train_accuracy double, val_accuracy double, "
    "test_accuracy double, train_f1 double, val_f1 double, test_f1 double, train_auc double, val_auc double, "
    "test_auc double, hyperparameters map<string,string>, feature_names array<string>, optimal_threshold double, "
    "preprocessing_steps array<string>, feature_selection_method string, class_imbalance_method string, "
    "model_path string, metadata_path string, config_path string, git_commit string, "
    "environment_info map<string,string>, notes string"
)


def newest(versions: DataFrame, keep: int = KEEP) -> DataFrame:
    """The ``keep`` newest versions per model, ties by version. Spark cuts each task to ``keep`` rows per model
    before the shuffle, so a model with many versions costs no more than any other."""
    w = W.partitionBy("model_name").orderBy(F.desc("created_at"), F.desc("version"))
    return versions.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= keep).drop("_rank")


def with_version(rows: DataFrame) -> DataFrame:
    """Version key and artifact paths of new rows."""
    keyed = rows if "version" in rows.columns else rows.withColumn("version", version_key(F.col("model_name"), F.col("created_at"), F.col("test_accuracy"), F.col("test_f1")))
    stem = F.concat_ws("_", "model_name", "version")
    return keyed.withColumns(
        {
            "model_path": F.concat(F.lit("models/"), stem),
            "metadata_path": F.concat(F.lit("metadata/"), stem, F.lit(".json")),
            "config_path": F.concat(F.lit("configs/"), stem, F.lit(".yaml")),
        }
    )


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _newest_commit(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """(number, snapshot folder) of the highest marker."""
    at, files = _files(spark, f"{path}/commits")
    if not files.exists(at):
        return None
    numbers = [int(n) for f in files.listStatus(at) if (n := f.getPath().getName()).isdigit()]
    if not numbers:
        return None
    top = max(numbers)
    return top, spark.read.text(f"{path}/commits/{top:010d}").first()[0]


def _commit(spark: SparkSession, path: str, number: int, folder: str) -> bool:
    """Whether the marker of this number could be set."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    aside, files = _files(spark, f"{path}/commits/_{uuid.uuid4().hex}")
    out = files.create(aside)
    out.write(bytearray(folder.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf)
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(aside, jvm.org.apache.hadoop.fs.Path(f"{path}/commits/{number:010d}"), options)
    except Py4JJavaError as e:
        files.delete(aside, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed snapshot."""
    at = _newest_commit(spark, path)
    if at is None:
        raise FileNotFoundError(f"no registry at {path}")
    return spark.read.parquet(f"{path}/{at[1]}")


def register(rows: DataFrame, path: str, keep: int = KEEP, tries: int = 20) -> None:
    """Add versions and commit the trimmed registry as the next snapshot; repeated on top of what others commit meanwhile."""
    spark = rows.sparkSession
    fresh = with_version(rows)
    for _ in range(tries):
        at = _newest_commit(spark, path)
        # Columns the caller leaves out are stored as null, so every snapshot has the full record.
        full = spark.createDataFrame([], FIELDS).unionByName(fresh, allowMissingColumns=True)
        if at is not None:
            full = spark.read.parquet(f"{path}/{at[1]}").unionByName(full)
        folder = f"snapshot-{uuid.uuid4().hex}"
        newest(full, keep).write.parquet(f"{path}/{folder}")
        if _commit(spark, path, 0 if at is None else at[0] + 1, folder):
            return
    raise RuntimeError(f"{tries} writers were faster at {path}")


def latest(versions: DataFrame) -> DataFrame:
    """Newest version per model."""
    rest = [c for c in versions.columns if c != "model_name"]
    best = F.max_by(F.struct(*rest), F.struct("created_at", "version"))
    return versions.groupBy("model_name").agg(best.alias("_v")).select("model_name", "_v.*")


def specific(versions: DataFrame, model: str, version: str) -> DataFrame:
    found = versions.filter((F.col("model_name") == model) & (F.col("version") == version))
    if found.isEmpty():
        raise ValueError(f"version {version} of {model} not found")
    return found


def history(versions: DataFrame, model: str) -> DataFrame:
    """Versions of one model, newest first."""
    return versions.filter(F.col("model_name") == model).orderBy(F.desc("created_at"), F.desc("version"))


def list_models(versions: DataFrame) -> DataFrame:
    """Rows (model_name, versions, newest created_at)."""
    return versions.groupBy("model_name").agg(F.count(F.lit(1)).alias("versions"), F.max("created_at").alias("created_at"))


_DELTAS = {"accuracy_delta": "test_accuracy", "f1_delta": "test_f1", "auc_delta": "test_auc"}


def compare(versions: DataFrame, model: str, version1: str, version2: str) -> DataFrame:
    """One row with the metric changes from version1 to version2; ValueError if either is missing."""
    first, second = specific(versions, model, version1), specific(versions, model, version2)
    both = first.alias("a").join(second.alias("b"), "model_name")
    return both.select(
        "model_name",
        F.col("a.version").alias("version1"),
        F.col("b.version").alias("version2"),
        *[(F.col(f"b.{m}") - F.col(f"a.{m}")).alias(out) for out, m in _DELTAS.items() if m in versions.columns],
    )


def compare_newest(versions: DataFrame) -> DataFrame:
    """Per model the changes from its second newest version to its newest; models with one version have no row.

    Joins two tables of at most one row per model.
    """
    w = W.partitionBy("model_name").orderBy(F.desc("created_at"), F.desc("version"))
    ranked = versions.withColumn("_rank", F.row_number().over(w)).filter("_rank <= 2")
    metrics = [m for m in _DELTAS.values() if m in versions.columns]

    def side(rank: int, suffix: str) -> DataFrame:
        return ranked.filter(F.col("_rank") == rank).select(
            "model_name", F.col("version").alias(f"version{suffix}"), *[F.col(m).alias(f"{m}_{suffix}") for m in metrics]
        )

    both = side(2, "1").join(side(1, "2"), "model_name")
    return both.select(
        "model_name", "version1", "version2",
        *[(F.col(f"{m}_2") - F.col(f"{m}_1")).alias(out) for out, m in _DELTAS.items() if m in metrics],
    )
