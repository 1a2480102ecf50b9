"""Exact deduplication of a growing folder by streaming state on disk."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.llm.common import SPACE, scratch, settings, text_or_empty
from ridgeline.session import settle

STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "400",
    # Many small stores: no space set aside in advance for the logs of each.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: str) -> Column:
    """The text with each run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(text_or_empty(text), SPACE, " ")


def sha256(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def _rows(source: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """Digest, content locator (file and row in it) and normalised text of every row."""
    at = F.col("_metadata")
    return source.select(
        F.col(id_col).alias("id"), at["file_path"].alias("file"), at["row_index"].alias("row"),
        normalised(text_col).alias("content"),
    ).withColumn("digest", digest(F.col("content")))


def remember(spark: SparkSession, path: str, id_col: str, text_col: str, digest: Callable[[Column], Column],
             checkpoint: str, batch_bytes: int) -> DataFrame:
    """Take in what is new below ``path``; the state of all rows so far.

    The state is a RocksDB store per shuffle partition, keyed by digest, without watermark or
    expiry, kept in ``checkpoint``: a later call with the same folder goes on from there. A key
    holds the smallest id, that row's locator, and a count.
    """
    schema = spark.read.parquet(path).schema
    with settings(spark, STATE):
        # As a pattern, the path may name one file as well as a folder.
        pattern = re.sub(r"(.)/*$", r"[\1]", path)
        stream = spark.readStream.schema(schema).option("maxBytesPerTrigger", str(batch_bytes)).parquet(pattern)
        rows = _rows(stream, id_col, text_col, digest)
        seen = rows.groupBy("digest").agg(
            # A null id comes after all others.
            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "file", "row")).alias("first"),
            F.count(F.lit(1)).alias("n"))
        query = (seen.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
                 .option("checkpointLocation", checkpoint).start())
        query.awaitTermination()
        state = spark.read.format("statestore").option("path", checkpoint).load()
        return settle(state.select("key.digest", F.col("value.min").alias("first"), F.col("value.count").alias("n")))


def exact_dedup(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column], Column] = sha256, checkpoint: str | None = None,
                batch_bytes: int = 64 << 30) -> DataFrame:
    """One row per row of the parquet files at ``path``: id, keep_id, group_size, kept, digest.

    Texts are equal when their normalised bytes are equal. A digest that occurs once needs no
    look at any text: its row comes out of the state. On hits the texts of the copies are
    compared byte by byte with the text that the locator names; texts that only share a digest
    are grouped again by the texts themselves.

    Only the rows of hits carry text through a shuffle; a digest with most rows is a skewed
    join, which is split while it runs.

    Null texts count as empty. Of equal texts the smallest id is kept; a null id only if the
    group has no other; among rows with the same id the first by file and row. Repeated rows
    are copies of each other. An empty table gives no rows. Other columns are not read.
    """
    checkpoint = checkpoint or scratch(spark, "dedup-state")
    state = remember(spark, path, id_col, text_col, digest, checkpoint, batch_bytes)
    alone = state.filter("n = 1").select(
        F.col("first.id").alias("id"), F.col("first.id").alias("keep_id"), F.col("n").alias("group_size"),
        F.lit(True).alias("kept"), "digest")

    hits = state.filter("n > 1")
    rows = _rows(spark.read.parquet(path), id_col, text_col, digest)
    copies = settle(rows.join(hits, "digest").withColumn(
        "is_first", (F.col("file") == F.col("first.file")) & (F.col("row") == F.col("first.row"))))
    first_text = copies.filter("is_first").select("digest", F.col("content").alias("first_content"))
    checked = settle(copies.join(first_text, "digest").select(
        "id", "file", "row", "digest", "first", "n", "is_first",
        (F.col("content") == F.col("first_content")).alias("same"),
        F.when(F.col("content") != F.col("first_content"), F.col("content")).alias("other")))

    differ = checked.filter("not same")
    same = checked.filter("same")
    if differ.isEmpty():
        sized = same.withColumn("size", F.col("n"))
    else:
        fewer = differ.groupBy("digest").agg(F.count(F.lit(1)).alias("out"))
        sized = same.join(fewer, "digest", "left").withColumn("size", F.col("n") - F.coalesce("out", F.lit(0)))
    grouped = sized.select("id", F.col("first.id").alias("keep_id"), F.col("size").alias("group_size"),
                           F.col("is_first").alias("kept"), "digest")

    again = differ.groupBy("digest", "other").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "file", "row")).alias("f"),
        F.count(F.lit(1)).alias("size"))
    collided = differ.join(again, ["digest", "other"]).select(
        "id", F.col("f.id").alias("keep_id"), F.col("size").alias("group_size"),
        ((F.col("file") == F.col("f.file")) & (F.col("row") == F.col("f.row"))).alias("kept"), "digest")
    return alone.unionByName(grouped).unionByName(collided).withColumnRenamed("id", id_col)
