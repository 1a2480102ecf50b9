"""Evaluation of a two-class prediction: ``label`` and ``pred`` are 0/1, ``score`` is any number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.functions.columns import cell_bounds, cell_in, missing, value_bucket
from ridgeline.session import settle


def _cells(df: DataFrame, label: str, pred: str) -> DataFrame:
    """The four counts of a two-class prediction as one row ``n00 n01 n10 n11`` (label, then pred)."""
    return df.agg(*[F.count_if((F.col(label) == i) & (F.col(pred) == j)).alias(f"n{i}{j}")
                    for i in (0, 1) for j in (0, 1)])


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Rows per label and prediction, including combinations that do not occur."""
    lines = [F.struct(F.lit(i).alias("label"), F.lit(j).alias("pred"), F.col(f"n{i}{j}").alias("n"))
             for i in (0, 1) for j in (0, 1)]
    return _cells(df, label, pred).select(F.inline(F.array(*lines)))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """precision, recall, f1 and support per class, their plain and support-weighted means, and accuracy.

    A ratio without a denominator is 0.  The accuracy stands in all three columns
    of its line.
    """
    cells = _cells(df, label, pred)
    scored = cells
    for c, o in ((0, 1), (1, 0)):
        hit, missed, false = F.col(f"n{c}{c}"), F.col(f"n{c}{o}"), F.col(f"n{o}{c}")
        scored = scored.withColumns({
            f"p{c}": _ratio(hit, hit + false), f"r{c}": _ratio(hit, hit + missed),
            f"f{c}": _ratio(2 * hit, 2 * hit + false + missed), f"s{c}": hit + missed,
        })
    total = F.col("s0") + F.col("s1")
    accuracy = _ratio(F.col("n00") + F.col("n11"), total)

    def line(name: str, p: Column, r: Column, f: Column, s: Column) -> Column:
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), s.alias("support"))

    def mean(c: str) -> Column:
        return (F.col(f"{c}0") + F.col(f"{c}1")) / 2

    def weighted(c: str) -> Column:
        return _ratio(F.col(f"{c}0") * F.col("s0") + F.col(f"{c}1") * F.col("s1"), total)
    lines = [line(c, *[F.col(f"{v}{c}") for v in "prfs"]) for c in ("0", "1")]
    lines += [line("macro avg", *[mean(v) for v in "prf"], total),
              line("weighted avg", *[weighted(v) for v in "prf"], total),
              line("accuracy", accuracy, accuracy, accuracy, total)]
    return scored.select(F.inline(F.array(*lines)))


def _ranked(df: DataFrame, label: str, score: str) -> DataFrame:
    """Counts per distinct score with running counts from the highest score down; no score, no row.

    The running sum is taken inside cells of nearby scores, and what lies above a
    cell is added up in three steps: cells of a bucket, buckets of a sixteenth of
    an octave, and those few thousand sixteenths.  A bucket with many distinct
    scores has accordingly more cells.
    """
    points = settle(
        df.filter(~missing(df, score))
        .groupBy(F.col(score).cast("double").alias("threshold"))
        .agg(F.sum(F.col(label).cast("long")).alias("_pos"),
             F.sum(1 - F.col(label).cast("long")).alias("_neg"))
        .withColumn("_bucket", value_bucket(F.col("threshold")))
        .withColumn("_coarse", F.floor(F.col("_bucket") / 4096))
    )
    spread = points.groupBy("_bucket").agg(*cell_bounds("threshold"))
    placed = points.join(spread, "_bucket").withColumn("_cell", cell_in(F.col("threshold")))
    cells = settle(placed.groupBy("_coarse", "_bucket", "_cell").agg(F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n")))
    p_all, n_all = cells.agg(F.coalesce(F.sum("_p"), F.lit(0)), F.coalesce(F.sum("_n"), F.lit(0))).first()

    def above(table: DataFrame, group: list[str], by: str, name: str) -> DataFrame:
        sums = table.groupBy(*group, by).agg(F.sum("_p").alias("_p"), F.sum("_n").alias("_n"))
        w = Window.partitionBy(*group).orderBy(F.desc(by)).rowsBetween(Window.unboundedPreceding, -1)
        return sums.select(*group, by, F.coalesce(F.sum("_p").over(w), F.lit(0)).alias(f"_p{name}"),
                           F.coalesce(F.sum("_n").over(w), F.lit(0)).alias(f"_n{name}"))

    starts = (above(cells, ["_coarse", "_bucket"], "_cell", "0")
              .join(above(cells, ["_coarse"], "_bucket", "1"), ["_coarse", "_bucket"])
              .join(above(cells, [], "_coarse", "2"), "_coarse"))
    inside = Window.partitionBy("_bucket", "_cell").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    return placed.join(starts, ["_coarse", "_bucket", "_cell"]).withColumns({
        "_tp": F.col("_p0") + F.col("_p1") + F.col("_p2") + F.sum("_pos").over(inside),
        "_fp": F.col("_n0") + F.col("_n1") + F.col("_n2") + F.sum("_neg").over(inside),
        "_p_all": F.lit(p_all), "_n_all": F.lit(n_all),
    })


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """True and false positive rate when everything scored at or above a threshold counts as 1."""
    return _ranked(df, label, score).select(
        "threshold",
        F.try_divide(F.col("_fp"), F.col("_n_all")).alias("fpr"),
        F.try_divide(F.col("_tp"), F.col("_p_all")).alias("tpr"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Chance that a random positive outscores a random negative, ties counting half."""
    won = F.col("_neg") * (F.col("_tp").cast("double") - F.col("_pos") / 2)
    pairs = F.max("_p_all").cast("double") * F.max("_n_all")
    return _ranked(df, label, score).agg(F.try_divide(F.sum(won), pairs).alias("auc"))
