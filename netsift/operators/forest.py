"""Random-forest training and scoring."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.config import DEFAULTS, ForestSettings
from netsift.operators.clean import binary_label, clean_all, clean_nonfinite, drop_incomplete, label_text
from netsift.operators.detect import classify, rule_detector
from netsift.schema import FEATURES, LABEL
from netsift.sinks.versions import Versions
from netsift.sources.tables import read_lake, read_training_csv

# Index 0 is benign and 1 is attack, whichever class is more frequent in the training data.
CLASSES = ["Normal", "Attack"]
TOO_FEW = "not enough rows"
NO_LABEL = "no label column"
ONE_CLASS = "only one class"


@dataclass(frozen=True)
class Training:
    """Outcome of a training job; ``skipped`` says why nothing was trained."""

    rows: int = 0
    attacks: int = 0
    skipped: str | None = None
    train_accuracy: float | None = None
    holdout_accuracy: float | None = None
    version: int | None = None
    model: PipelineModel | None = field(default=None, repr=False, compare=False)


def build_pipeline(forest: ForestSettings = DEFAULTS.forest) -> Pipeline:
    indexer = StringIndexerModel.from_labels(CLASSES, inputCol="label", outputCol="label_indexed")
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="error")
    classifier = RandomForestClassifier(
        labelCol="label_indexed",
        featuresCol="features",
        numTrees=forest.trees,
        maxDepth=forest.depth,
        impurity=forest.impurity,
        featureSubsetStrategy=forest.subset,
        seed=forest.seed,
    )
    return Pipeline(stages=[indexer, assembler, classifier])


def gate(labelled: DataFrame, forest: ForestSettings = DEFAULTS.forest) -> Training:
    """Row counts of labelled rows, and whether they suffice; one pass."""
    counts = labelled.agg(
        F.count("*").alias("rows"), F.count_if(F.col("label") == "Attack").alias("attacks")
    ).first()
    rows, attacks = counts["rows"], counts["attacks"]
    skipped = TOO_FEW if rows < forest.min_rows else ONE_CLASS if attacks in (0, rows) else None
    return Training(rows, attacks, skipped)


def train(labelled: DataFrame, forest: ForestSettings = DEFAULTS.forest) -> Training:
    """Fit the forest on clean features and ``label``.

    The held-out share is chosen by a hash of the row, so it is the same rows
    however often a task runs again.
    """
    checked = gate(labelled, forest)
    if checked.skipped:
        return checked
    held_out = F.pmod(F.xxhash64(*FEATURES), F.lit(100)) < forest.holdout_percent
    split = labelled.select(*FEATURES, "label", held_out.alias("held_out"))
    model = build_pipeline(forest).fit(split.filter(~F.col("held_out")))
    right = (F.col("prediction") == F.col("label_indexed")).cast("double")
    scores = model.transform(split).agg(
        F.avg(F.when(~F.col("held_out"), right)).alias("train"), F.avg(F.when(F.col("held_out"), right)).alias("test")
    ).first()
    return Training(
        checked.rows, checked.attacks, None, scores["train"], scores["test"], model=model
    )


def save_model(model: PipelineModel, path: str) -> None:
    """Save a model, replacing an earlier one at the same path."""
    model.write().overwrite().save(path)


def publish(training: Training, versions: Versions) -> Training:
    """Save a trained model as a new version; does nothing when training was skipped."""
    if training.skipped:
        return training
    version, location = versions.new_location()
    save_model(training.model, location)
    versions.publish(version, location, training.rows, training.holdout_accuracy)
    return Training(
        training.rows, training.attacks, None, training.train_accuracy, training.holdout_accuracy, version, training.model
    )


def from_lake(df: DataFrame) -> DataFrame | None:
    """Training lake rows with text label and clean features; None without a label column."""
    return clean_all(label_text(df)) if LABEL in df.columns else None


def from_csv(df: DataFrame) -> DataFrame | None:
    """Complete CSV rows with binary label and finite features; None without a label column."""
    return binary_label(clean_nonfinite(drop_incomplete(df))) if "label" in df.columns else None


def retrain(spark: SparkSession, lake: str, versions: Versions, forest: ForestSettings = DEFAULTS.forest) -> Training:
    """Train on the training lake and publish the model."""
    prepared = from_lake(read_lake(spark, lake))
    return Training(skipped=NO_LABEL) if prepared is None else publish(train(prepared, forest), versions)


def train_csv(spark: SparkSession, path: str, versions: Versions, forest: ForestSettings = DEFAULTS.forest) -> Training:
    """Train on labelled CSV files and publish the model."""
    prepared = from_csv(read_training_csv(spark, path))
    return Training(skipped=NO_LABEL) if prepared is None else publish(train(prepared, forest), versions)


def score(df: DataFrame, model: PipelineModel | None) -> DataFrame:
    """Add ``prediction``, ``attack_probability`` and ``attack_type`` to clean flows.

    Without a model the rules predict, and the probability is NULL.
    """
    if model is None:
        return classify(rule_detector(df).withColumn("attack_probability", F.lit(None).cast("double")))
    # The first stage indexes the training label, which flows do not have.
    scored = PipelineModel(model.stages[1:]).transform(df)
    probability = vector_to_array("probability")[1]
    return classify(scored.withColumn("attack_probability", probability).drop("features", "rawPrediction", "probability"))


class ModelCache:
    """The newest published model; it is loaded again only when the version changes."""

    def __init__(self, versions: Versions | None):
        self.versions = versions
        self.version: int | None = None
        self.model: PipelineModel | None = None

    def current(self) -> PipelineModel | None:
        newest = self.versions.latest() if self.versions else None
        if newest is not None and newest["version"] != self.version:
            self.model = PipelineModel.load(newest["location"])
            self.version = newest["version"]
        return self.model
