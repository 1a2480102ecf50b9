"""What one fitted model says: scores, report and importance, from a single fit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.operators import metrics as mt
from ridgeline.operators import models as md
from ridgeline.operators import trees
from ridgeline.session import settle


def boosted_model(train: DataFrame, inputs: list[str], label: str = "Target", given: dict = md.BOOSTED_TEST) -> str:
    """Path of the boosted trees of these settings; see ``models.stored_fit``."""
    return md.stored_fit(md.weigh_positive(train, label, given["positive_weight"]), inputs, md.boosted(label, **given))


def forest_model(train: DataFrame, inputs: list[str], label: str = "Target", given: dict = md.FOREST_SCAN) -> str:
    return md.stored_fit(md.weigh_balanced(train, label), inputs, md.forest(label, **given))


def scores(path: str, rows: DataFrame) -> DataFrame:
    """Chance ``p`` and class ``predicted`` of every row by the stored model."""
    return md.score(md.load(path), rows)


def report(scored: DataFrame, label: str = "Target") -> DataFrame:
    """Precision, recall, f1 and support per class, their means, the accuracy, and the area under the ROC curve (``auc``)."""
    area = mt.roc_auc(scored, label, "p").select(F.lit("auc").alias("class"), "auc")
    return mt.class_report(scored, label, "predicted").unionByName(area, allowMissingColumns=True)


def importance(path: str, rows: DataFrame, inputs: list[str], top: int = 15) -> DataFrame:
    """The ``top`` inputs by how often the trees split on them, with gain beside it."""
    return trees.importance(rows.sparkSession, path, inputs).filter(F.col("place") <= top)


def study(path: str, held_out: DataFrame, inputs: list[str], period: str, label: str = "Target", top: int = 15) -> DataFrame:
    """Scores of all ``held_out`` rows, the report of those in ``period``, and the inputs that count, as one long table.

    ``part`` names the table a row belongs to; the columns of the others are NULL. The model is loaded, not fitted.
    """
    scored = settle(scores(path, held_out).select("ticker", "date", "split", label, "p", "predicted"))
    parts = {"scores": scored, "report": report(scored.filter(F.col("split") == period), label),
             "importance": importance(path, held_out, inputs, top)}
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [df.withColumn("part", F.lit(name)) for name, df in parts.items()])
