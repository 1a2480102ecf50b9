"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import cell_of, placed, shuffle_order
from ridgeline.session import settle

CELLS = 4096


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", source_col: str = "source",
          seed: str = "shard-1") -> DataFrame:
    """``docs`` with ``shard`` (from 0) and ``slot`` (from 0, gapless): every shard holds the mixture of sources.

    Rows of a source are ranked in seeded order; rank - 1/2 over the number of its rows is the
    place of a row in (0, 1); rows in order of these places are cut into shards whose counts
    differ by one at most (law: rows). Both rankings run in cells, 4,096 per source and 4,096
    over all, so neither a large source nor the whole order is one task. They move ids and sources
    only; whole rows are stored once and joined to their places once.

    Null ids and null sources are values like others. Repeated rows and equal ids take slots of
    their own next to each other in their source's order; which of two identical rows comes first does not show.
    Text plays no part. An empty table gives no rows. Columns called shard or slot are replaced;
    other names do not matter, as the row travels as one value.
    """
    keep = [c for c in docs.columns if c not in ("shard", "slot")]
    # The rows are stored under a number and meet their place once; what is ranked is narrow.
    rows = settle(docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(source_col).alias("source"),
                              F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("number")))
    narrow = rows.select("number", "source", "id", shuffle_order(seed, "id").alias("order")).withColumn("cell", cell_of(F.col("order")))
    by_source = placed(narrow, ["source"], "cell", [F.col("order"), F.col("id"), F.col("number")]).alias("r")
    sizes = narrow.groupBy("source").agg(F.count(F.lit(1)).alias("n")).alias("s")
    share = (2 * F.col("place") - 1) / (2 * F.col("n"))
    stored = settle(by_source.join(sizes, F.col("r.source").eqNullSafe(F.col("s.source")))
                    .select("r.number", "r.source", "r.order", share.alias("share"))
                    .withColumn("cell", F.floor(F.col("share") * CELLS)))
    total = stored.count()
    placing = placed(stored, [], "cell", [F.col("share"), F.col("source").asc_nulls_last(), F.col("order"), F.col("number")])
    at = F.col("place") - 1
    cut = placing.withColumn("_shard", F.expr(f"((place - 1) * {shards}L) div {max(total, 1)}L"))
    start = F.expr(f"(_shard * {max(total, 1)}L + {shards - 1}L) div {shards}L")
    cut = settle(cut.select("number", F.col("_shard").cast("int").alias("shard"), (at - start).alias("slot")))
    return rows.select("number", "row").join(cut, "number").select("row.*", "shard", "slot")
