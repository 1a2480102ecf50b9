"""Near duplicates: universal minima, bands, verification, connected components."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm import kernels as kn
from ridgeline.llm import screen
from ridgeline.llm.common import settings
from ridgeline.llm.components import components
from ridgeline.session import settle

#: At a similarity of 0.8, 32 bands of 4 minima miss a pair once in 20 million.
BANDS, ROWS = 32, 4
SEED = 20
#: A pair at 0.8 agrees on less than 0.55 of 128 minima once in 10 ** 10.
LEAST_AGREEMENT = 0.55
#: The two figures above hold from here on; at 0.6 bands and agreement would lose 14 links in a hundred.
LEAST_PERCENT = 80
BLOCK = 1024


def multipliers() -> tuple[np.ndarray, np.ndarray]:
    """Multiply-add-shift hashing: x -> high bits of a * x + b, with odd a."""
    rng = np.random.default_rng(SEED)
    a = rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingles(words: list[bytes], k: int, hashes: kn.WordHashes) -> np.ndarray:
    """Sorted distinct hashes of all runs of k words; fewer words are one run."""
    if not words:
        return np.zeros(0, np.uint64)
    h = hashes.of(words)
    return np.unique(kn.grams(h, min(k, len(h))))


def minima(found: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    least = np.full(len(a), np.uint64(0xFFFFFFFFFFFFFFFF))
    for i in range(0, len(found), 1024):
        least = np.minimum(least, (found[i:i + 1024, None] * a + b).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32)


def band_keys(sig: np.ndarray) -> np.ndarray:
    key = np.arange(BANDS, dtype=np.uint64)
    for part in sig.reshape(BANDS, ROWS).T.astype(np.uint64):
        key = kn.mixed(key * kn.ODD + part)
    return key.view(np.int64)


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share at least ``percent`` of their union."""
    if len(x) > len(y):
        x, y = y, x
    if 100 * len(x) < percent * len(y):
        return False
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    both = int((y[at] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _binary(column: pa.Array, i: int, kind) -> np.ndarray:
    return np.frombuffer(column[i].as_buffer(), dtype=kind)


def _profiles(docs: DataFrame, k: int) -> DataFrame:
    """One narrow row per document: digest of its words, size of its set, keys of its bands."""
    def run(batches):
        hashes, (a, b) = kn.WordHashes(), multipliers()
        for batch in batches:
            for part in kn.pieces(batch, "text"):
                digest, size, bands = [], [], []
                for text in part.column("text").to_pylist():
                    words = kn.space_words(text)
                    found = shingles(words, k, hashes)
                    digest.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
                    size.append(len(found))
                    bands.append(band_keys(minima(found, a, b)) if len(found) else None)
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"), "row_key": part.column("row_key"), "row_key2": part.column("row_key2"),
                    "digest": pa.array(digest, pa.binary()), "n_shingles": pa.array(size, pa.int64()),
                    "bands": pa.array(bands, pa.list_(pa.int64()))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, row_key long, row_key2 long, digest binary, n_shingles long, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(node, n, sig, items) for the stored ``wanted`` (row_key, row_key2, node).

    A bitmap of the wanted rows, as large as their number asks for, keeps the other texts from being cut into words and
    moved; the join afterwards removes what the bitmap let through.
    """
    bits = screen.bits_for(wanted.count())
    bitmap = screen.bitmap(wanted.select("row_key"), bits)

    def run(batches):
        hashes, (a, b) = kn.WordHashes(), multipliers()
        for batch in batches:
            keys = batch.column("row_key").to_numpy(zero_copy_only=False).astype(np.int64)
            keep = np.flatnonzero(kn.in_bitmap(bitmap.value, bits, keys.view(np.uint64)))
            texts = batch.column("text")
            second = batch.column("row_key2")
            row, sig, items = [], [], []

            def made():
                return pa.record_batch({"row_key": pa.array(keys[row]), "row_key2": second.take(pa.array(row, pa.int64())),
                                        "sig": pa.array(sig, pa.binary()), "items": pa.array(items, pa.binary())})

            for i in keep.tolist():
                found = shingles(kn.space_words(texts[i].as_py()), k, hashes)
                if len(found):
                    row.append(i)
                    sig.append(minima(found, a, b).tobytes())
                    items.append(found.tobytes())
                if len(row) == 256:
                    yield made()
                    row, sig, items = [], [], []
            if row:
                yield made()

    found = docs.select("row_key", "row_key2", "text").mapInArrow(run, "row_key long, row_key2 long, sig binary, items binary")
    # Rows repeated with id and text give the same set twice.
    once = found.join(wanted, ["row_key", "row_key2"]).groupBy("node").agg(F.first("sig").alias("sig"), F.first("items").alias("items"))
    return settle(once.withColumn("n", F.octet_length("items") / 8))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough; agreement of the minima rules most others out first."""
    one = sets.select(F.col("node").alias("u"), F.col("sig").alias("su"), F.col("items").alias("iu"))
    two = sets.select(F.col("node").alias("v"), F.col("sig").alias("sv"), F.col("items").alias("iv"))

    def run(batches):
        for batch in batches:
            good = []
            su, sv, iu, iv = (batch.column(c) for c in ("su", "sv", "iu", "iv"))
            for i in range(batch.num_rows):
                agree = (_binary(su, i, np.uint32) == _binary(sv, i, np.uint32)).mean()
                if agree >= LEAST_AGREEMENT and similar(_binary(iu, i, np.uint64), _binary(iv, i, np.uint64), percent):
                    good.append(i)
            yield pa.record_batch({c: batch.column(c).take(pa.array(good, pa.int64())) for c in ("u", "v")})

    return pairs.join(one, "u").join(two, "v").select("u", "v", "su", "sv", "iu", "iv").mapInArrow(run, "u long, v long")


def _open_units(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """What is still to be compared: (bucket, part, side, node, root, main) in blocks of bounded size.

    Inside a bucket all have been compared with its smallest node. Rows whose root is the
    bucket's commonest one need no comparison with each other, so each block of the others
    meets each block of all. Rows grow with the bucket if few are left over; a bucket of m nodes
    that mostly stay apart, as texts with much in common but too little, makes m * m / BLOCK rows.
    """
    rooted = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    counts = rooted.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("c"))
    buckets = counts.groupBy("bucket").agg(F.max(F.struct("c", "root")).alias("top"), F.sum("c").alias("m"), F.count(F.lit(1)).alias("roots")).filter("roots > 1")
    buckets = buckets.select("bucket", F.col("top.root").alias("main"), F.ceil(F.col("m") / BLOCK).alias("nb"),
                             F.ceil((F.col("m") - F.col("top.c")) / BLOCK).alias("nr"))
    open_rows = rooted.join(buckets, "bucket")
    block = F.pmod(F.xxhash64("node"), F.col("nb"))
    of_rest = F.pmod(F.xxhash64("node"), F.col("nr"))
    zero = F.lit(0).cast("long")
    as_all = open_rows.withColumn("part", F.explode(F.transform(
        F.sequence(zero, F.col("nr") - 1), lambda r: r * F.col("nb") + block))).withColumn("side", F.lit(0))
    as_rest = open_rows.filter("root <> main").withColumn("part", F.explode(F.transform(
        F.sequence(zero, F.col("nb") - 1), lambda b: of_rest * F.col("nb") + b))).withColumn("side", F.lit(1))
    return as_all.unionByName(as_rest).select("bucket", "band", "part", "side", "node", "root", "main")


def _compared(table: pa.Table, percent: int, exact: bool) -> tuple[list[int], list[int]]:
    """Row numbers (i on side 1, j on side 0) of pairs with different roots that may be, or are, similar.

    A pair belongs to the first band it shares, so it is looked at in one bucket only. With
    ``exact``, roots joined on the way are not compared again.
    """
    side = table.column("side").to_numpy()
    root = table.column("root").to_numpy().copy()
    size = table.column("n").to_numpy().astype(np.int64)
    band = int(table.column("band")[0].as_py())
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(-1, BANDS * ROWS)
    keys = sig.reshape(-1, BANDS, ROWS)
    items = [np.frombuffer(x, np.uint64) for x in table.column("items").to_pylist()] if exact else None
    every = np.flatnonzero(side == 0)
    left, right = [], []
    for i in np.flatnonzero(side == 1):
        near = every[(root[every] != root[i]) & (100 * np.minimum(size[every], size[i]) >= percent * np.maximum(size[every], size[i]))]
        if not len(near):
            continue
        near = near[(sig[near] == sig[i]).mean(axis=1) >= LEAST_AGREEMENT]
        if band and len(near):
            near = near[~(keys[near, :band] == keys[i, :band]).all(axis=2).any(axis=1)]
        if not exact:
            left += [i] * len(near)
            right += near.tolist()
            continue
        for j in near.tolist():
            if root[j] != root[i] and similar(items[i], items[j], percent):
                left.append(i)
                right.append(j)
                root[root == root[j]] = root[i]
    return left, right


def _more_links(rows: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components (u, v: their roots), from all comparisons that the stars leave open."""
    units = _open_units(rows, roots)
    small = sets.select("node", "sig", "n")
    key = ["bucket", "part"]

    def may(_, table):
        left, right = _compared(table, percent, exact=False)
        keep = pa.array(sorted(set(left) | set(right)), pa.int64())
        return table.select(["bucket", "band", "part", "side", "node", "root"]).take(keep)

    maybe = settle(units.join(small, "node").groupBy(*key).applyInArrow(
        lambda k, t: may(k, t), "bucket long, band int, part long, side int, node long, root long"))

    def are(_, table):
        left, right = _compared(table, percent, exact=True)
        root = table.column("root")
        pick = lambda at: root.take(pa.array(at, pa.int64())).combine_chunks()
        return pa.table({"u": pick(left), "v": pick(right)})

    return maybe.join(sets, "node").groupBy(*key).applyInArrow(lambda k, t: are(k, t), "u long, v long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, key, first_key.

    Documents whose sets of k-word shingles share ``percent`` of their union are linked.
    Texts with the same words are one node from the start, however many copies there are.
    Texts that share a band are candidates. First every candidate is compared with the
    smallest node of its bucket; components of those links are found; then the pairs of a
    bucket that are still apart are compared block by block, so no link between different
    texts is lost and no bucket is listed pair by pair. All links are confirmed on full sets.
    Bands and signatures are made for 80 percent and more; a lower ``percent`` is refused.

    Null or empty texts, and texts of white space, have no shingles and link with nothing;
    each is its own component. A text of fewer than k words is one shingle. A null id is
    larger than any other and never names a component unless all its ids are null. Repeated
    rows are copies; ``key``, two 64-bit hashes of id and text, marks them, and ``first_key`` is that
    of the row with the component's smallest id. An empty table gives no rows. Very long
    texts are whole; a text's set is held by one task. Other columns are not read.
    """
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent must be from {LEAST_PERCENT} to 100: below, bands and signatures lose links")
    # All that runs Python is stored inside; a batch holds a thousand texts, or pairs of sets, at most.
    with settings(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}):
        return _near_duplicates(docs, id_col, text_col, k, percent)


def _near_duplicates(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumns(row_keys("doc_id", "text"))
    profiles = settle(_profiles(d, k))
    least = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key", "row_key2")
    # Numbers that are stored once are unique, as hashes of very many texts need not be.
    nodes = settle(profiles.filter("n_shingles > 0").groupBy("digest").agg(F.min(least).alias("first"), F.min("bands").alias("bands"))
                   .withColumn("node", F.monotonically_increasing_id()))

    rows = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    # Stored, so that the rows of a crowded bucket are a join that Spark can split.
    crowded = settle(rows.groupBy("bucket").agg(F.min("node").alias("center"), F.count(F.lit(1)).alias("m")).filter("m > 1"))
    members = settle(rows.join(crowded, "bucket").filter("node <> center"))
    stars = settle(members.select(F.col("center").alias("u"), F.col("node").alias("v")).distinct())
    in_stars = stars.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    sets = _sets(d, settle(nodes.join(in_stars, "node").select("node", "first.row_key", "first.row_key2")), k)
    links = settle(_verified(stars, sets, percent))
    roots = components(links)
    more = settle(_more_links(members.filter("m > 2").select("bucket", "band", "node"), roots, sets, percent))
    if not more.isEmpty():
        both = links.unionByName(more)
        roots = components(both)

    of_node = nodes.join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("root"), "first")
    named = settle(of_node.groupBy("root").agg(F.min("first").alias("least")))
    named = of_node.select("digest", "root").join(named, "root").select(
        "digest", F.col("least.doc_id").alias("component_id"), F.struct("least.row_key", "least.row_key2").alias("first_key"))
    key = F.struct("row_key", "row_key2")
    out = profiles.filter("n_shingles > 0").join(named, "digest").select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), key.alias("key"), "first_key")
    return out.unionByName(profiles.filter("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"), key.alias("key"), key.alias("first_key")))


def row_keys(id_col: str, text_col: str) -> dict:
    """Two 64-bit hashes of id and text, which together tell rows apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return {"row_key": F.xxhash64(id_col, text), "row_key2": F.xxhash64(F.lit("second"), F.col(id_col), text)}


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id. Documents without words all stay.

    Rows that repeat an id and its text count once; nulls as in ``near_duplicates``.
    """
    found = near_duplicates(docs, id_col, text_col, k, percent)
    keep = found.filter("key = first_key").select(F.col("key.row_key").alias("_key"), F.col("key.row_key2").alias("_key2")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    first, second = row_keys(id_col, text_col).values()
    keyed = docs.select(row, first.alias("_key"), second.alias("_key2"))
    return keyed.join(keep, ["_key", "_key2"], "left_semi").dropDuplicates(["_key", "_key2"]).select("row.*")
