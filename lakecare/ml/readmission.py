"""Readmission prediction: features, training, evaluation, scoring."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecare.functions import rules
from lakecare.functions.clock import AsOf, as_of_timestamp
from lakecare.session import owned_scratch, stage

# Model inputs and training parameters.
CATEGORIES = ("gender", "age_group", "ward", "los_bucket", "claim_type")
NUMBERS = (
    "age", "length_of_stay", "total_amount", "coverage_ratio", "risk_score", "admission_month",
    "is_weekend_admission",
)
LEAKY = ("risk_score",)  # contains the readmission flag it is meant to predict
TREES, DEPTH, LEAF_ROWS, SEED = 100, 8, 5, 42
GRID_TREES, GRID_DEPTH, FOLDS = (50, 100), (6, 8), 3
TRAIN_PERCENT = 80
FIT_PARTS = 24  # partitions of rows chosen from more; a forest ships its counts once per partition and level
CACHED_ROWS = 2_000_000  # training rows up to which vectors are cached and the forests of a fold fitted side by side
FACT_INPUTS = (
    "patient_id", "hospital_id", "admission_date", "length_of_stay", "diagnosis_code", "ward", "age",
    "age_group", "total_amount", "coverage_ratio", "claim_type", "readmission_flag",
)
PERSON_INPUTS = ("risk_score", "gender", "insurance_provider")
ROW_KEY = ("patient_id", "admission_date", "claim_type", "total_amount", "coverage_ratio")
SCORES = (
    "patient_id", "hospital_id", "admission_date", "label", "readmission_predicted", "readmission_probability",
    "risk_band", "_scored_at",
)


def ml_features(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Model rows: facts with the patient's risk, calendar features and the label."""
    people = dim.select("patient_id", *PERSON_INPUTS)
    day = F.col("admission_date")
    filled = {c: F.coalesce(c, F.lit(0.0)) for c in ("total_amount", "coverage_ratio", "risk_score")}
    return (
        fact.select(*FACT_INPUTS)
        .join(people, "patient_id", "left")
        .withColumns(
            {
                "label": F.col("readmission_flag").cast("int"),
                "admission_month": F.month(day),
                "admission_dayofweek": F.dayofweek(day),
                "is_weekend_admission": rules.weekend_flag(day),
                "los_bucket": rules.stay_bucket(F.col("length_of_stay")),
                **filled,
            }
        )
        .dropna(subset=["label", "age", "length_of_stay"])
    )


def label_distribution(features: DataFrame) -> DataFrame:
    return features.groupBy("label").agg(F.count(F.lit(1)).alias("rows")).orderBy("label")


def hash_bucket(n: int, *columns: str, salt: int = SEED) -> Column:
    """Stable bucket of a row: independent of partitioning, retries and row order."""
    return F.pmod(F.xxhash64(F.lit(salt), *columns), F.lit(n)).cast("int")


def split(features: DataFrame, key: tuple[str, ...] = ROW_KEY, percent: int = TRAIN_PERCENT) -> tuple[DataFrame, DataFrame]:
    side = hash_bucket(100, *key) < percent
    return features.where(side), features.where(~side)


def feature_stages(drop_leaky: bool = False) -> list:
    numbers = [c for c in NUMBERS if not (drop_leaky and c in LEAKY)]
    indexed, encoded = [f"{c}_idx" for c in CATEGORIES], [f"{c}_ohe" for c in CATEGORIES]
    return [
        StringIndexer(inputCols=list(CATEGORIES), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded),
        VectorAssembler(inputCols=encoded + numbers, outputCol="features_raw", handleInvalid="keep"),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
    ]


def category_index(features: DataFrame) -> DataFrame:
    """Position of each category in the fitted indexers: most frequent first, ties by name; nulls have none.

    The rows come from the fitted indexer, one per known category.
    """
    indexer = feature_stages()[0].fit(features)
    rows = [
        (name, category, at)
        for name, known in zip(CATEGORIES, indexer.labelsArray, strict=True)
        for at, category in enumerate(known)
    ]
    return features.sparkSession.createDataFrame(rows, "feature string, category string, position long")


def scaler_summary(features: DataFrame) -> DataFrame:
    """Mean and sample deviation by which the fitted scaler shifts and divides each numeric input."""
    assembler = VectorAssembler(inputCols=list(NUMBERS), outputCol="features_raw", handleInvalid="keep")
    scaler = feature_stages()[-1].fit(assembler.transform(features))
    rows = [(c, float(m), float(d)) for c, m, d in zip(NUMBERS, scaler.mean, scaler.std, strict=True)]
    return features.sparkSession.createDataFrame(rows, "feature string, mean double, deviation double")


def vector_slots(features: DataFrame) -> DataFrame:
    """(slot, rows_set, total) of the assembled vectors: one-hot slots by category, numbers by name.

    A vector has one slot per known category and number; sums combine before the shuffle. Most slots
    of a row are zero, and adding those as decimals would be most of the work, so they are only counted.
    """
    prepared = Pipeline(stages=feature_stages()[:3]).fit(features).transform(features)
    attributes = prepared.schema["features_raw"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attributes.values() for a in group}
    each = prepared.select(F.posexplode(vector_to_array("features_raw")).alias("at", "value"))
    known = ~F.isnan("value")
    there = (F.col("value") != 0) & known
    total = F.coalesce(F.sum(F.when(there, F.col("value").cast("decimal(28,8)"))).cast("double"), F.lit(0.0))
    summed = each.groupBy("at").agg(
        F.count_if(there).alias("rows_set"), F.when(F.count_if(known) > 0, F.round(total, 2)).alias("total")
    )
    slots = F.create_map(*[x for i, n in sorted(names.items()) for x in (F.lit(i), F.lit(n))])
    return summed.select(slots[F.col("at")].alias("slot"), "rows_set", "total")


@dataclass
class Trained:
    model: PipelineModel
    metrics: dict[str, float]
    params: dict[str, str]
    fold_auc: list[float] = field(default_factory=list)


def train(
    features: DataFrame,
    parallelism: int = 4,
    grid_trees: tuple[int, ...] = GRID_TREES,
    grid_depth: tuple[int, ...] = GRID_DEPTH,
    folds: int = FOLDS,
    drop_leaky: bool = False,
    fit_rows: int | None = None,
) -> Trained:
    """Grid search by cross-validated ROC area, then the best forest on all training rows.

    The feature stages are fitted anew with every fold, so no fold that validates a forest has
    shaped its inputs; the forests of a fold share them. Folds come from a row hash. Fitting takes all
    training rows, testing and scoring all rows; only a caller who asks for ``fit_rows`` has about as
    many, chosen by a row hash, fitted on.

    The columns of the training rows are cached in memory and on disk. The vectors made of them are several
    times as large: of more than ``CACHED_ROWS`` rows they are written as compressed Parquet instead. A forest
    caches its own binned rows, so of as many rows one is fitted at a time; they are enough for all cores.
    """
    training, testing = split(features)
    fold = hash_bucket(folds, *ROW_KEY, salt=SEED + 1).alias("fold")
    wanted = training if fit_rows is None else fit_sample(training, fit_rows)
    rows = wanted.select(*CATEGORIES, *NUMBERS, "label", fold).persist(StorageLevel.MEMORY_AND_DISK)
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=LEAF_ROWS, seed=SEED
    )
    grid = (
        ParamGridBuilder().addGrid(forest.numTrees, list(grid_trees)).addGrid(forest.maxDepth, list(grid_depth)).build()
    )
    counts = {"train_size": rows.count(), "test_size": testing.count()}
    large = counts["train_size"] > CACHED_ROWS
    workers = 1 if large else parallelism
    areas = [
        fold_areas(rows.where(F.col("fold") != f), rows.where(F.col("fold") == f), forest, grid, workers, drop_leaky, large)
        for f in range(folds)
    ]
    means = np.mean(areas, axis=0)
    prepared = Pipeline(stages=feature_stages(drop_leaky)).fit(rows)
    with kept_vectors(prepared, rows, large) as vectors:
        best = forest.fit(vectors, grid[int(np.argmax(means))])
    rows.unpersist()
    # A fitted forest refers to its session through the training summary, which cannot be
    # sent to tasks once a row count was observed in that session; a copy has no summary.
    model = PipelineModel(stages=[*prepared.stages, best.copy()])
    params = {"model_type": "RandomForestClassifier", **{k: str(v) for k, v in counts.items()}}
    return Trained(model, evaluate(model, testing), params, means.tolist())


def fit_sample(training: DataFrame, fit_rows: int) -> DataFrame:
    """About ``fit_rows`` of the rows, chosen by a row hash; all of them if there are no more.

    The chosen rows are gathered in ``FIT_PARTS`` partitions, in an order of their own: left where they
    lay, they would be a few per partition, and a forest's cost would grow with the partitions.
    """
    share = fit_rows / max(1, training.count())
    if share >= 1:
        return training
    chosen = training.where(hash_bucket(1 << 30, *ROW_KEY, salt=SEED + 2) < int(share * (1 << 30)))
    return chosen.repartition(FIT_PARTS, *ROW_KEY).sortWithinPartitions(*ROW_KEY)


@contextmanager
def kept_vectors(prepared: PipelineModel, rows: DataFrame, large: bool) -> Iterator[DataFrame]:
    """The rows' vectors for use inside the block: cached, or of many rows written to scratch."""
    vectors = prepared.transform(rows).select("features", "label")
    if large:
        with owned_scratch(rows.sparkSession):
            yield stage(vectors, "vectors")
        return
    vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield vectors
    finally:
        vectors.unpersist()


def fold_areas(
    training: DataFrame,
    validating: DataFrame,
    forest: RandomForestClassifier,
    grid: list[dict],
    parallelism: int,
    drop_leaky: bool,
    large: bool = False,
) -> list[float]:
    """ROC area on the validating rows of each forest of the grid, fitted on the training rows, some at a time."""
    if training.isEmpty() or validating.isEmpty():
        raise ValueError("a fold without rows to fit on or to validate with")
    prepared = Pipeline(stages=feature_stages(drop_leaky)).fit(training)
    roc = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    session = training.sparkSession

    with kept_vectors(prepared, training, large) as vectors, kept_vectors(prepared, validating, large) as unseen:

        def area(params: dict) -> float:
            return roc.evaluate(forest.fit(vectors, params).copy().transform(unseen))  # without its summary, see train

        with ThreadPoolExecutor(parallelism) as pool:
            return list(pool.map(inheritable_thread_target(session)(area), grid))


def evaluate(model: PipelineModel, rows: DataFrame) -> dict[str, float]:
    scored = model.transform(rows).select("label", "prediction", "rawPrediction").persist(StorageLevel.MEMORY_AND_DISK)
    measures = {
        "auc_roc": BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC"),
        "auc_pr": BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderPR"),
        "accuracy": MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy"),
        "f1_score": MulticlassClassificationEvaluator(labelCol="label", metricName="f1"),
    }
    values = {name: evaluator.evaluate(scored) for name, evaluator in measures.items()}
    scored.unpersist()
    return values


def score(model: PipelineModel, features: DataFrame, as_of: AsOf) -> DataFrame:
    """Probability, prediction and band for every row."""
    probability = F.round(vector_to_array("probability")[1], 4)
    return (
        model.transform(features)
        .withColumns(
            {
                "readmission_probability": probability,
                "readmission_predicted": F.col("prediction").cast("boolean"),
                "risk_band": rules.risk_band(probability),
                "_scored_at": as_of_timestamp(as_of),
            }
        )
        .select(*SCORES)
    )


def risk_band_distribution(scored: DataFrame) -> DataFrame:
    return scored.groupBy("risk_band").agg(F.count(F.lit(1)).alias("patients")).orderBy("risk_band")


def feature_importances(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Importance per named vector slot. The rows come from the fitted model, one per slot."""
    attributes = model.transform(features.limit(1)).schema["features_raw"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attributes.values() for a in group}
    weights = model.stages[-1].featureImportances
    rows = [(names.get(i, str(i)), float(weights[i])) for i in range(weights.size)]
    return features.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def metrics_table(spark: SparkSession, trained: Trained, run_id: str, as_of: AsOf) -> DataFrame:
    """Parameters and metrics of one run as rows."""
    rows = [(run_id, "param", k, v, None) for k, v in trained.params.items()]
    rows += [(run_id, "metric", k, None, v) for k, v in trained.metrics.items()]
    layout = "run_id string, kind string, name string, text_value string, value double"
    return spark.createDataFrame(rows, layout).withColumn("logged_at", as_of_timestamp(as_of))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
