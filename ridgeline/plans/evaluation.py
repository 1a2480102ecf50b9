"""How well a trained model does on a held-out period."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from ridgeline.operators import metrics as mt
from ridgeline.operators import models as md
from ridgeline.session import settle


def evaluate(model: PipelineModel, inputs: list[str], held_out: DataFrame, label: str = "Target",
             top: int = 15) -> dict[str, DataFrame]:
    """Per-class report with accuracy, confusion counts, ROC points and area, and the leading inputs."""
    scored = settle(md.score(model, held_out).select(label, "p", "predicted"))
    return {
        "report": mt.class_report(scored, label, "predicted"),
        "confusion": mt.confusion(scored, label, "predicted"),
        "roc": mt.roc_curve(scored, label, "p"),
        "auc": mt.roc_auc(scored, label, "p"),
        "importance": md.importance(model, inputs, held_out.sparkSession, top),
    }
