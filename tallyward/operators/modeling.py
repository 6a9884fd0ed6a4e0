"""Random-forest risk models with Spark ML: split, weigh, fit, evaluate, choose.

Rows stay on the executors. The driver sees fitted models, a handful of scores and one importance
per feature.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyward.operators.features import fill_numbers
from tallyward.operators.silver import now_or
from tallyward.sources.contracts import column_names, contract

# The model inputs, in order: every number of the feature table but the label.
FEATURES = tuple(
    c
    for c in column_names("gold.provider_fraud_features")
    if c not in ("Provider", "fraud_label", "gold_processed_timestamp")
)
# The label, its classes, and the two candidates.
LABEL = "fraud_label"
CLASSES = (0, 1)
SEED = 42
TEST_SHARE = 0.2
MODEL_TYPE = "RandomForestClassifier"
TRAIN, TEST, UNUSED = "train", "test", "unused"


@dataclass(frozen=True)
class ForestSpec:
    """A candidate. ``partitions`` is the layout of the training rows, on which the drawn samples
    depend: part of the model, and logged with it."""

    run_name: str
    trees: int
    depth: int
    seed: int = SEED
    class_weight: str = "balanced"
    memory_mb: int = 1024
    partitions: int = 32


CANDIDATES = (
    ForestSpec("random_forest_provider_fraud", trees=100, depth=8),
    ForestSpec("random_forest_deeper_model", trees=200, depth=12),
)


def model_frame(features: DataFrame) -> DataFrame:
    """Provider, the 18 inputs and the label, with 0 for every null number."""
    return fill_numbers(features.select("Provider", *FEATURES, LABEL))


def known_label() -> Column:
    return F.coalesce(F.col(LABEL).isin(*CLASSES), F.lit(False))


def require_labels(frame: DataFrame) -> None:
    """ValueError unless every label is 0 or 1, with the counts; one aggregate."""
    found = frame.agg(
        F.count_if(F.col(LABEL).isNull()).alias("null"),
        F.count_if(F.col(LABEL).isNotNull() & ~known_label()).alias("other"),
    ).first()
    if found["null"] or found["other"]:
        raise ValueError(
            f"labels must be 0 or 1: {found['null']} rows have none, {found['other']} another"
        )


def split_rows(
    frame: DataFrame, share: float = TEST_SHARE, seed: int = SEED, exact: bool = True
) -> DataFrame:
    """Add ``split``, train or test, chosen by a hash of the provider.

    The test rows are the rounded share of each label's count. With ``exact=False`` the hash alone
    decides: no shuffle, and each label's test share is ``share`` up to chance. No row is dropped:
    those whose label is neither 0 nor 1 are marked unused.
    """
    if exact:
        return _split_exactly(frame, share, seed)
    drawn = F.pmod(_draw(seed), F.lit(1000)) < round(share * 1000)
    side = F.when(drawn, TEST).otherwise(TRAIN)
    return frame.withColumn("split", F.when(known_label(), side).otherwise(UNUSED))


def _draw(seed: int) -> Column:
    """A number below 2^60 that depends on the provider and the seed only."""
    digest = F.md5(F.concat_ws(":", "Provider", F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


SPLIT_CELLS = 4096


def _split_exactly(frame: DataFrame, share: float, seed: int) -> DataFrame:
    """The rows with the smallest draws of each label, up to its quota.

    Draws fall into numbered cells. Whole cells are test or train by the running count of their
    label, and rows are ranked in the one cell per label that the quota cuts through.
    """
    drawn = frame.filter(known_label()).withColumns(
        {"draw": _draw(seed), "cell": F.pmod(_draw(seed), F.lit(SPLIT_CELLS))}
    )
    running = Window.partitionBy(LABEL).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    quota = F.round(F.sum("count").over(Window.partitionBy(LABEL)) * share)
    # At most two labels times SPLIT_CELLS rows, whatever the size of the frame.
    cells = (
        drawn.groupBy(LABEL, "cell")
        .count()
        .withColumn("open", quota - F.coalesce(F.sum("count").over(running), F.lit(0)))
    )
    placed = drawn.join(F.broadcast(cells), [LABEL, "cell"])
    is_cut = (F.col("open") > 0) & (F.col("open") < F.col("count"))
    whole = placed.filter(~is_cut).withColumn("chosen", F.col("open") >= F.col("count"))
    by_draw = Window.partitionBy(LABEL, "cell").orderBy("draw", "Provider")
    cut = placed.filter(is_cut).withColumn("chosen", F.row_number().over(by_draw) <= F.col("open"))
    return (
        whole.unionByName(cut)
        .select(*frame.columns, F.when(F.col("chosen"), TEST).otherwise(TRAIN).alias("split"))
        .unionByName(frame.filter(~known_label()).withColumn("split", F.lit(UNUSED)))
    )


def require_both_labels(split: DataFrame) -> None:
    """ValueError unless train and test each hold both labels; one aggregate."""
    cells = {
        f"{side}, {label}": F.count_if((F.col("split") == side) & (F.col(LABEL) == label))
        for side in (TRAIN, TEST)
        for label in CLASSES
    }
    found = split.agg(*[count.alias(name) for name, count in cells.items()]).first().asDict()
    absent = [name for name, count in found.items() if not count]
    if absent:
        raise ValueError(f"no rows for {absent}: too few providers to split by label")


def class_balance(split: DataFrame) -> DataFrame:
    """Share of each label within train and within test."""
    counts = split.groupBy("split", LABEL).count()
    total = F.sum("count").over(Window.partitionBy("split"))
    return counts.select("split", LABEL, "count", (F.col("count") / total).alias("proportion"))


def class_weights(train: DataFrame) -> DataFrame:
    """(label, weight): rows / (labels * rows of the label), for the labels 0 and 1."""
    counts = train.filter(known_label()).groupBy(LABEL).count()
    everything = Window.partitionBy(F.lit(1))
    rows, labels = F.sum("count").over(everything), F.count("*").over(everything)
    return counts.select(LABEL, (rows / (labels * F.col("count"))).alias("class_weight"))


def weigh(train: DataFrame) -> DataFrame:
    """Attach the class weights, null for other labels; the broadcast side has two rows at most."""
    return train.join(F.broadcast(class_weights(train)), LABEL, "left")


def training_rows(train: DataFrame, spec: ForestSpec) -> DataFrame:
    """Weighted rows in the layout of the candidate, the same however the input was dealt out."""
    return weigh(train).repartition(spec.partitions, "Provider").sortWithinPartitions(
        "Provider", LABEL, *FEATURES
    )


def fit_forest(train: DataFrame, spec: ForestSpec) -> PipelineModel:
    """Fit on weighted rows, which are kept while the fit passes over them several times."""
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="inputs")
    forest = RandomForestClassifier(
        featuresCol="inputs",
        labelCol=LABEL,
        weightCol="class_weight",
        numTrees=spec.trees,
        maxDepth=spec.depth,
        seed=spec.seed,
        maxMemoryInMB=spec.memory_mb,
    )
    rows = training_rows(train, spec).persist()
    try:
        return Pipeline(stages=[assembler, forest]).fit(rows)
    finally:
        rows.unpersist()


def predict(model: PipelineModel, frame: DataFrame) -> DataFrame:
    """Add ``predicted_fraud_label`` and ``fraud_probability``."""
    return (
        model.transform(frame)
        .withColumns(
            {
                "predicted_fraud_label": F.col("prediction").cast("int"),
                "fraud_probability": vector_to_array("probability")[1],
            }
        )
        .drop("inputs", "rawPrediction", "probability", "prediction")
    )


def classification_metrics(predicted: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 in one row; 0 where the divisor is 0."""

    def hits(truth: int, guess: int) -> Column:
        return F.count_if((F.col(LABEL) == truth) & (F.col("predicted_fraud_label") == guess))

    cells = predicted.agg(
        hits(1, 1).alias("tp"),
        hits(0, 1).alias("fp"),
        hits(1, 0).alias("fn"),
        hits(0, 0).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    return cells.select(
        share(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    )


def roc_auc(predicted: DataFrame) -> float:
    """Area under the ROC curve over every distinct score; ties count half."""
    scored = predicted.select(
        F.col("fraud_probability").alias("score"), F.col(LABEL).cast("double").alias("truth")
    )
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="truth", metricName="areaUnderROC", numBins=0
    )
    return float(evaluator.evaluate(scored))


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(feature_name, importance_score) of a fitted model."""
    scores = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(score)) for name, score in zip(FEATURES, scores)]
    return spark.createDataFrame(rows, "feature_name string, importance_score double")


@dataclass(frozen=True)
class Run:
    """One fitted candidate with its scores on the test rows."""

    run_id: str
    spec: ForestSpec
    model: PipelineModel
    metrics: dict[str, float]
    path: str | None = None


def train_candidate(
    split: DataFrame,
    spec: ForestSpec,
    model_root: str | None = None,
    keep: Callable[[DataFrame], DataFrame] = lambda scores: scores,
) -> Run:
    """Fit on the train rows, evaluate on the test rows, store the model below ``model_root``.

    ``split`` is best a stored table, as the fit reads it several times. ``keep`` stores the scored
    test rows, so that both metrics come from one pass over the trees.
    """
    train = split.filter(F.col("split") == TRAIN).drop("split")
    test = split.filter(F.col("split") == TEST).drop("split")
    model = fit_forest(train, spec)
    scores = keep(
        predict(model, test).select(
            "Provider", LABEL, "predicted_fraud_label", "fraud_probability"
        )
    )
    metrics = classification_metrics(scores).first().asDict()
    metrics["roc_auc"] = roc_auc(scores)
    run_id = uuid.uuid4().hex
    path = None
    if model_root:
        path = f"{model_root}/{run_id}"
        model.write().save(path)
    return Run(run_id, spec, model, metrics, path)


def run_log(spark: SparkSession, runs: Sequence[Run], run_ts: Column | None = None) -> DataFrame:
    """One row per run: parameters, metrics, where the model lies."""
    target = contract("models.model_runs")
    rows = [
        (r.run_id, r.spec.run_name, MODEL_TYPE, r.spec.trees, r.spec.depth, r.spec.class_weight,
         r.spec.partitions,
         *[r.metrics[m] for m in ("accuracy", "precision", "recall", "f1_score", "roc_auc")],
         r.path)
        for r in runs
    ]
    logged = spark.createDataFrame(rows, type(target)(target.fields[:-1]))
    return logged.withColumn("created_at", now_or(run_ts))


def best_run(runs: DataFrame) -> DataFrame:
    """The run with the highest ROC AUC; the newest of equals. An undefined AUC never wins."""
    known = F.when(~F.isnan("roc_auc"), F.col("roc_auc"))
    return runs.orderBy(known.desc_nulls_last(), F.col("created_at").desc(), "run_id").limit(1)


CHAMPION = "champion"


def registry_entry(
    best: DataFrame,
    model_name: str,
    version: int,
    description: str,
    tags: dict[str, str],
    run_ts: Column | None = None,
) -> DataFrame:
    """The row that makes a run the champion version of a model; its AUC joins the tags."""
    pairs = [F.lit(x) for item in tags.items() for x in item]
    pairs += [F.lit("metric_roc_auc"), F.col("roc_auc").cast("string")]
    return best.select(
        F.lit(model_name).alias("model"),
        F.lit(version).cast("int").alias("version"),
        F.lit(CHAMPION).alias("alias"),
        "run_id",
        "path",
        F.lit(description).alias("description"),
        F.create_map(*pairs).alias("tags"),
        now_or(run_ts).alias("created_at"),
    )


def champion(registry: DataFrame, model_name: str) -> DataFrame:
    """The newest row that carries the champion alias."""
    named = registry.filter((F.col("model") == model_name) & (F.col("alias") == CHAMPION))
    return named.orderBy(F.col("version").desc(), F.col("created_at").desc()).limit(1)
