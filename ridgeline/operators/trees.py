"""A fitted tree ensemble as a table of its nodes, and what can be read off it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BOOSTED, FOREST = "boosted", "forest"


def kind(spark: SparkSession, path: str) -> str:
    """Whether the stored model adds up weighted trees (``boosted``) or averages them (``forest``)."""
    about = spark.read.text(f"{path}/stages/*/metadata").agg(F.max(F.col("value").contains("GBTClassificationModel"))).first()[0]
    return BOOSTED if about else FOREST


def nodes(spark: SparkSession, path: str, inputs: list[str]) -> DataFrame:
    """One row per node of the model stored at ``path``, which was fitted on ``inputs``.

    tree, node (0 is the root), weight (of the tree), count (weighted training rows), value (of the leaf: what a boosted
    tree adds, or a forest's share of class 1); for inner nodes feature, threshold (smaller or equal goes left), left,
    right and gain, which are NULL for leaves.
    """
    stored = spark.read.parquet(f"{path}/stages/*/data").select("treeID", "nodeData.*")
    weights = spark.read.parquet(f"{path}/stages/*/treesMetadata").toDF("tree", "_about", "weight").select("tree", "weight")
    inner = F.col("leftChild") >= 0
    stats = F.col("impurityStats")
    if kind(spark, path) == BOOSTED:  # trees of squared error: rows, their sum, their squares' sum
        count, value = stats[0], F.col("prediction")
    else:  # trees of classes: rows of each
        count = F.aggregate(stats, F.lit(0.0), lambda a, b: a + b)
        value = F.try_divide(stats[1], count)
    name = F.array(*[F.lit(c) for c in inputs])
    split = F.col("split")

    def of_inner(c):
        return F.when(inner, c)
    return stored.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"), count.alias("count"), value.alias("value"),
        of_inner(F.get(name, split["featureIndex"])).alias("feature"), of_inner(split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        of_inner(F.col("leftChild")).alias("left"), of_inner(F.col("rightChild")).alias("right"), of_inner(F.col("gain")).alias("gain"),
    ).join(weights, "tree")


def importance(spark: SparkSession, path: str, inputs: list[str]) -> DataFrame:
    """Per input: how often it splits, and the gain of those splits as a share of all.

    ``splits`` counts inner nodes and ``place`` ranks by it; ``importance`` weighs each split's gain by the rows it
    divides, in a forest after each tree's gains are made to add up to 1, and ``gain_place`` ranks by it.
    Ties go by name. Inputs that no tree uses have 0.
    """
    used = nodes(spark, path, inputs).filter("feature IS NOT NULL").groupBy("tree", "feature").agg(
        F.sum(F.col("gain") * F.col("count")).alias("gain"), F.count(F.lit(1)).alias("splits"))
    if kind(spark, path) == FOREST:
        whole = F.sum("gain").over(Window.partitionBy("tree"))
        used = used.withColumn("gain", F.coalesce(F.try_divide("gain", whole), F.lit(0.0)))
    sums = used.groupBy("feature").agg(F.sum("gain").alias("gain"), F.sum("splits").alias("splits"))
    every = spark.createDataFrame([(c,) for c in inputs], "feature string")
    # One row per input from here on.
    all_rows = Window.partitionBy(F.lit(0))
    found = every.join(sums, "feature", "left").select(
        "feature", F.coalesce("splits", F.lit(0)).cast("long").alias("splits"),
        F.coalesce(F.try_divide("gain", F.sum("gain").over(all_rows)), F.lit(0.0)).alias("importance"))
    return found.withColumns({
        "place": F.row_number().over(all_rows.orderBy(F.desc("splits"), "feature")).cast("long"),
        "gain_place": F.row_number().over(all_rows.orderBy(F.desc("importance"), "feature")).cast("long")})
