"""Tree-ensemble scoring with ``pyspark.ml``."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.session import lasting_dir
from ridgeline.sources import files

# Settings of the three models the analysis trains.
BOOSTED_TEST = dict(trees=300, rate=0.03, depth=6, rows=0.8, columns=0.8, positive_weight=1.2)
BOOSTED_SCAN = dict(trees=400, rate=0.02, depth=6, rows=0.85, columns=0.85, positive_weight=2.0)
FOREST_SCAN = dict(trees=500, depth=12, min_leaf=5)
SEED = 42

# Training rows of one task: so many tables of up to 64 tasks, then larger ones.
FEW, MANY = 4_096, 1 << 20


def boosted(label: str = "Target", trees: int = 300, rate: float = 0.03, depth: int = 6, rows: float = 0.8,
            columns: float = 0.8, **_ignored) -> GBTClassifier:
    return GBTClassifier(labelCol=label, featuresCol="_inputs", weightCol="_weight", maxIter=trees,
                         stepSize=rate, maxDepth=depth, subsamplingRate=rows,
                         featureSubsetStrategy=str(columns), seed=SEED)


def forest(label: str = "Target", trees: int = 500, depth: int = 12, min_leaf: int = 5) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, featuresCol="_inputs", weightCol="_weight", numTrees=trees,
                                  maxDepth=depth, minInstancesPerNode=min_leaf, seed=SEED)


def weigh_positive(df: DataFrame, label: str, weight: float) -> DataFrame:
    """Weight rows of class 1 by ``weight``."""
    return df.withColumn("_weight", F.when(F.col(label) == 1, float(weight)).otherwise(1.0))


def weigh_balanced(df: DataFrame, label: str) -> DataFrame:
    """Weight rows so that both classes count the same: n over twice the class size."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_size")).collect()
    total = sum(r["_size"] for r in sizes)
    weight = F.lit(None).cast("double")
    for r in sizes:
        weight = F.when(F.col(label) == r[label], total / (2.0 * r["_size"])).otherwise(weight)
    return df.withColumn("_weight", weight)


def fit(train: DataFrame, inputs: list[str], estimator) -> PipelineModel:
    """Fit on a table that has a ``_weight`` column."""
    columns = [*inputs, "_weight", estimator.getLabelCol()]
    return Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="_inputs"), estimator]).fit(
        train.select(*columns))


def score(model: PipelineModel, df: DataFrame, out: str = "p") -> DataFrame:
    """Add the probability of class 1 and the class it implies.

    A missing input is no number, which is not smaller than any threshold: such a row goes right at splits on it.
    """
    assembler, trees = model.stages
    scored = trees.transform(assembler.copy({assembler.handleInvalid: "keep"}).transform(df.drop("_weight")))
    chance = vector_to_array("probability")[1]
    return scored.select(*[c for c in df.columns if c != "_weight"], chance.alias(out),
                         F.col("prediction").cast("int").alias("predicted"))


def stored_fit(train: DataFrame, inputs: list[str], estimator) -> str:
    """Path of the model fitted on a table that has a ``_weight`` column; fitted once per table and settings.

    The model is kept outside of any ``workspace``, in a folder named by the estimator's settings, the inputs and a
    checksum of all training rows, so another call with the same gets the stored one, also in a later session that has
    the same shared folder. Rows are dealt out by their values and sorted, because samples are drawn per
    task: the same table gives the same samples however it was read.
    """
    spark = train.sparkSession
    label = estimator.getLabelCol()
    columns = [*inputs, "_weight", label]
    rows = train.select(*columns)
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.lit(0))).first()
    given = {p.name: str(v) for p, v in estimator.extractParamMap().items()}
    about = json.dumps([type(estimator).__name__, sorted(given.items()), columns, n, str(total), spark.version])
    path = f"{lasting_dir(spark)}/model-{hashlib.sha256(about.encode()).hexdigest()}"
    if not files.exists(spark, path):
        tasks = max(-(-n // MANY), min(64, -(-n // FEW)), 1)
        model = fit(rows.repartition(tasks, *columns).sortWithinPartitions(*columns), inputs, estimator)
        staged = f"{path}-{uuid.uuid4().hex}"
        model.write().save(staged)
        files.move_new(spark, staged, path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def importance(model: PipelineModel, inputs: list[str], spark, n: int = 15) -> DataFrame:
    """The ``n`` inputs with the largest gain-based importance; ``trees.importance`` has split counts beside it."""
    weights = model.stages[-1].featureImportances.toArray()
    table = spark.createDataFrame([(c, float(v)) for c, v in zip(inputs, weights)],
                                  "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(n)
