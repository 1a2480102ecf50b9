"""Benchmark decontamination by winnowed fingerprints."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm import kernels as kn
from ridgeline.llm import screen
from ridgeline.llm.common import text_or_empty
from ridgeline.session import settle

#: Of every 6 neighbouring runs of 5 words one is kept, so any shared span of 5 + 6 - 1 = 10 words shares a kept run.
GRAM, WINDOW = 5, 6
SPAN = GRAM + WINDOW - 1
FINGERPRINT = "key binary, pos int, hash long"


def winnow(h: np.ndarray) -> np.ndarray:
    """Places of the smallest hash of every window, all places on a tie; fewer hashes are one window."""
    if not len(h):
        return np.zeros(0, np.int64)
    w = min(WINDOW, len(h))
    windows = len(h) - w + 1
    least = h[:windows].copy()
    for j in range(1, w):
        np.minimum(least, h[j:j + windows], out=least)
    kept = np.zeros(len(h), bool)
    for j in range(w):
        kept[j:j + windows] |= h[j:j + windows] == least
    return np.flatnonzero(kept)


def fingerprints(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the kept runs of a text's word hashes."""
    g = kn.grams(words, GRAM)
    at = winnow(g)
    return at, g[at]


def _of_items(items: DataFrame) -> DataFrame:
    """Fingerprints of long items; for an item of fewer than 10 words, the hash of all of it."""
    def run(batches):
        hashes = kn.WordHashes()
        for batch in batches:
            key, pos, value, n = [], [], [], []
            for k, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                h = hashes.of(kn.plain_words(text))
                at, g = fingerprints(h) if len(h) >= SPAN else (np.zeros(min(len(h), 1), int), kn.grams(h, len(h)) if len(h) else h)
                key += [k] * len(at)
                pos += at.tolist()
                value += g.view(np.int64).tolist()
                n += [len(h)] * len(at)
            yield pa.record_batch({"key": pa.array(key, pa.binary()), "pos": pa.array(pos, pa.int32()),
                                   "hash": pa.array(value, pa.int64()), "n": pa.array(n, pa.int32())})

    return items.mapInArrow(run, FINGERPRINT + ", n int")


def _of_docs(docs: DataFrame, bitmap, short: list[int]) -> DataFrame:
    """Per document its number of words, and the prints that the benchmark's bitmap lets through.

    Prints are winnowed; runs of the short items' lengths are looked up at every place.
    """
    bits = screen.BITS
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        hashes = kn.WordHashes()
        for batch in batches:
            for part in kn.pieces(batch, "text"):
                n_words, prints = [], []
                for text in part.column("text").to_pylist():
                    h = hashes.of(kn.plain_words(text))
                    n_words.append(len(h))
                    here = []
                    for at, g in [fingerprints(h)] + [(np.arange(len(g)), g) for g in (kn.grams(h, n) for n in short)]:
                        ok = kn.in_bitmap(bitmap.value, bits, g)
                        here += [{"pos": p, "hash": v} for p, v in zip(at[ok].tolist(), g[ok].view(np.int64).tolist())]
                    prints.append(here)
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"), "key": part.column("key"), "n_words": pa.array(n_words, pa.int64()),
                    "prints": pa.array(prints, pa.list_(pa.struct([("pos", pa.int32()), ("hash", pa.int64())])))})

    return docs.mapInArrow(run, f"doc_id {kind}, key binary, n_words long, prints array<struct<pos:int,hash:long>>")


def extended(doc: list[bytes], item: list[bytes], seeds: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Longest equal runs through the seeds (places in document and item): (from, to, place in item).

    Runs of 10 words or of the whole item count, since every window of 10 item words inside such a run occurs in the document.
    """
    least, out, done = min(SPAN, len(item)), [], {}
    for d, i in sorted(seeds):
        if done.get(d - i, -1) > d:
            continue
        a, b = d, d
        while a > 0 and i - (d - a) > 0 and doc[a - 1] == item[i - (d - a) - 1]:
            a -= 1
        while b < len(doc) and i + (b - d) < len(item) and doc[b] == item[i + (b - d)]:
            b += 1
        done[d - i] = max(b, d + 1)
        if b - a >= least:
            out.append((a, b, i - (d - a)))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, key, n_words, n_hit, items (ids with occurring windows), spans.

    Fingerprints of documents are joined with those of the benchmark; only fingerprints that
    pass the benchmark's bitmap (fixed size, never too strict) leave their task. Hits are then extended on the
    words themselves, so the result is exact: every shared window is found, and hash
    collisions fall away. Equal texts are looked at once and the result is joined back.

    ``spans`` lists (from, to, item_id) in words. Null or empty text has no words. An item
    without words never occurs; items of fewer than 10 words must occur whole. Repeated items
    count once if id and words agree; a null item id counts as the empty id. Repeated rows of
    ``docs``, equal ids and null ids each keep their row. An empty benchmark leaves every
    document clean; an empty table gives no rows. Other columns are not read.
    """
    items = settle(benchmark.select(F.col(item_col).cast("string").alias("item_id"), text_or_empty(item_text_col).alias("text"))
                   .fillna("", ["item_id"]).distinct().withColumn("key", F.unhex(F.md5(F.concat_ws("\n", "item_id", "text")))))
    prints = settle(_of_items(items))
    short = sorted(r.n for r in prints.filter(f"n < {SPAN}").select("n").distinct().collect())
    d = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("key", F.unhex(F.md5("text")))

    profiles = settle(_of_docs(d, screen.bitmap(prints.select("hash")), short))
    found = profiles.select("key", F.inline("prints")).alias("d")
    seeds = found.join(prints.alias("p"), "hash").select(
        F.col("d.key").alias("key"), F.col("p.key").alias("item"), F.col("d.pos").alias("at"), F.col("p.pos").alias("item_at"))
    # One row per document and item; copies of a text bring the same seeds.
    pairs = settle(seeds.groupBy("key", "item").agg(F.collect_set(F.struct("at", "item_at")).alias("seeds")))
    texts = d.select("key", "text").join(pairs.select("key").distinct(), "key").groupBy("key").agg(F.first("text").alias("text"))
    work = (pairs.join(items.select(F.col("key").alias("item"), "item_id", F.col("text").alias("item_text")), "item")
            .groupBy("key").agg(F.collect_list(F.struct("item_id", "item_text", "seeds")).alias("items")).join(texts, "key"))

    def run(batches):
        for batch in batches:
            key, hit, ids, spans = [], [], [], []
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                words = kn.plain_words(row["text"])
                mark, names, here = np.zeros(len(words), bool), set(), []
                for item in row["items"]:
                    for a, b, _ in extended(words, kn.plain_words(item["item_text"]), [(s["at"], s["item_at"]) for s in item["seeds"]]):
                        mark[a:b] = True
                        names.add(item["item_id"])
                        here.append({"from": a, "to": b, "item_id": item["item_id"]})
                if here:
                    key.append(row["key"])
                    hit.append(int(mark.sum()))
                    ids.append(sorted(names))
                    spans.append(here)
            yield pa.record_batch({"key": pa.array(key, pa.binary()), "n_hit": pa.array(hit, pa.int64()), "items": pa.array(ids, pa.list_(pa.string())),
                                   "spans": pa.array(spans, pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64()), ("item_id", pa.string())])))})

    hits = settle(work.select("key", "text", "items").mapInArrow(
        run, "key binary, n_hit long, items array<string>, spans array<struct<from:long,to:long,item_id:string>>"))
    return profiles.drop("prints").join(hits, "key", "left").select(
        "doc_id", "key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans")


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose text holds a window of a benchmark item; all others stay, repeated rows too."""
    found = contamination(docs, benchmark, id_col, text_col, **options)
    dirty = found.filter("n_hit > 0").select(F.col("key").alias("_key")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, F.unhex(F.md5(text_or_empty(text_col))).alias("_key"))
    return keyed.join(dirty, "_key", "left_anti").select("row.*")
