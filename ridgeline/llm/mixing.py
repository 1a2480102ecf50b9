"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import WORD, cell_of, placed, shuffle_order, text_or_empty
from ridgeline.session import settle

SEED = "mix-1"


def words(text: str) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def cycle_weights(sources: DataFrame, source: str = "source", weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Add ``weight``: the given weights in turn, by the source's code points, null last."""
    leading = F.coalesce(F.ascii(source), F.lit(1 << 21))
    ranked = placed(sources.withColumn("_cell", leading), [], "_cell", [F.col(source).asc_nulls_last()])
    nth = F.pmod(F.col("place") - 1, F.lit(len(weights)))
    return ranked.withColumn("weight", F.get(F.array(*map(F.lit, weights)), nth.cast("int"))).drop("_cell", "place")


def water_fill(sources: DataFrame, max_epochs: int = 3) -> DataFrame:
    """Add ``target``: the total ``source_size`` shared by ``weight``, no source above ``max_epochs`` times its size.

    Every round clamps the sources whose share is too large and shares what is left among the
    others by weight; the share of one unit of weight only rises, so rounds end when no
    source is newly clamped. A round is one aggregate over the table of sources and brings
    two numbers to the driver. Without any words all targets are 0.
    """
    cap = F.col("source_size") * max_epochs
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, clamped = 0.0, -1
    while True:
        over = cap <= F.lit(level) * F.col("weight")
        n, used, free = sources.agg(F.count_if(over), F.coalesce(F.sum(F.when(over, cap)), F.lit(0)),
                                    F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0))).first()
        if n == clamped or not free:
            break
        clamped, level = n, (total - used) / free
    return sources.withColumn("target", F.when(over, cap.cast("double")).otherwise(F.lit(level) * F.col("weight")))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights: DataFrame | None = None, max_epochs: int = 3, seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """The sources' shares, and the size of every document.

    Shares: source, source_size, weight, target, ``whole`` (times each document is taken) and
    ``cut`` (documents whose seeded order does not exceed it are taken once more). Documents
    up to the cut hold the fractional part of the target, to within half a document. Only ids,
    sources and sizes are shuffled; a source with most rows is ranked in 4,096 cells.
    ``weights`` (source, weight) replaces the cycle 1, 2, 3.
    """
    size = words(text_col)
    sizes = settle(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"))
                   .withColumn("order", shuffle_order(seed, "doc_id", "size")))
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    if weights is None:
        weighted = cycle_weights(sources)
    else:
        w = weights.select(F.col(weights.columns[0]).alias("_s"), F.col(weights.columns[1]).alias("weight"))
        weighted = sources.join(w, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s").fillna(0, ["weight"])
    shares = settle(water_fill(settle(weighted), max_epochs))
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    shares = shares.withColumn("whole", F.floor(epochs)).withColumn("part", epochs - F.col("whole"))

    units = sizes.groupBy("source", "order").agg(F.sum("size").alias("size")).withColumn("cell", cell_of(F.col("order")))
    ordered = placed(units, ["source"], "cell", [F.col("order")], "size").alias("u")
    s = shares.select(F.col("source").alias("_s"), "part", "source_size")
    extra = (ordered.join(s, F.col("u.source").eqNullSafe(F.col("_s")))
             .filter(F.col("before") + F.col("size") / 2 <= F.col("part") * F.col("source_size"))
             .filter("part > 0").groupBy("source").agg(F.max("order").alias("cut")).alias("c"))
    shares = settle(shares.alias("s").join(extra, F.col("s.source").eqNullSafe(F.col("c.source")), "left")
                    .select("s.*", "c.cut"))
    return shares, sizes


def repeats(rows: DataFrame, shares: DataFrame) -> DataFrame:
    """Add ``repeats``, ``target`` and ``source_size`` to rows with ``source`` and ``order``; decided row by row."""
    s = shares.select(F.col("source").alias("_s"), "source_size", "target", "whole", "cut")
    more = F.coalesce(F.col("order") <= F.col("cut"), F.lit(False)).cast("long")
    return (rows.join(s, F.col("source").eqNullSafe(F.col("_s"))).withColumn("repeats", F.col("whole") + more)
            .drop("_s", "whole", "cut"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: DataFrame | None = None, max_epochs: int = 3, seed: str = SEED) -> DataFrame:
    """The mixture itself: ``docs``, each row as often as the mix takes it, with its own columns only.

    A document is taken whole, 0 to ``max_epochs`` times. Size is the number of words; null text
    has none. A null source is a source of its own, ranked last. Rows with the same id and size
    are taken alike, so repeated rows and null ids have a defined result, at the price that
    they count as one unit at the cut. Documents without words are taken like others of their
    source. An empty table gives an empty mixture. Names of extra columns do not matter.
    """
    shares, _ = plan(docs, id_col, text_col, source_col, weights, max_epochs, seed)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words(text_col).alias("size"))
    drawn = repeats(keyed.withColumn("order", shuffle_order(seed, "doc_id", "size")), shares)
    taken = drawn.filter("repeats > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), "repeats")).alias("_n"))
    return taken.select("row.*")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, size, source, source_size, target, taken, repeats."""
    shares, sizes = plan(docs, **options)
    return repeats(sizes, shares).select("doc_id", "size", "source", "source_size", "target",
                                         (F.col("size") * F.col("repeats")).alias("taken"), "repeats")
