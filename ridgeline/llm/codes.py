"""Vectors as short codes: a codebook per part, nearest entries found by integer Walsh-Hadamard transforms."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.session import settle

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
I8 = np.int64
#: Parts of one step: partial distances of so many to all entries are held at once.
BLOCK = 256
#: All entries get three quarters of the coefficients, which array steps add up fastest; those still open then get so many at a time.
THEN = 2


def sequency(size: int) -> np.ndarray:
    """The Walsh-Hadamard matrix of a power of two, rows by their number of sign changes, entries 1 and -1."""
    h = np.ones((1, 1), I8)
    while len(h) < size:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((h[:, 1:] != h[:, :-1]).sum(axis=1), kind="stable")]


def largest(width: int) -> int:
    """Components up to this size keep all sums of a part of ``width`` exact in 64 bits: size ** 3 * (2 x) ** 2 < 2 ** 62."""
    size = 1 << max(width - 1, 0).bit_length()
    return int((2 ** 60 // size ** 3) ** 0.5)


class Codebook:
    """Entries of one part, with their transforms; finds nearest entries exactly."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries.astype(I8)
        width = self.entries.shape[1]
        self.size = 1 << max(width - 1, 0).bit_length()
        self.matrix = sequency(self.size)[:, :width].T.copy()  # zero padding: the other columns meet zeros
        self.turned = self.entries @ self.matrix

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each row's nearest entry, the lowest of equals, and the squared distance.

        The transform multiplies every squared distance by the padded size, so sums of squared differences of
        coefficients are exact multiples of it, and sums over the first coefficients are lower bounds. The entry
        with the least such sum is measured whole; entries whose sum has passed that are out.
        """
        index, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), I8)
        for i in range(0, len(parts), BLOCK):
            index[i:i + BLOCK], distance[i:i + BLOCK] = self._block(parts[i:i + BLOCK].astype(I8) @ self.matrix)
        return index, distance // self.size

    def _block(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y, done = self.turned, self.size - self.size // 4
        # No coefficient is larger than size times a component, so most tables fit half as many bits, exactly.
        most = max(np.abs(x).max(initial=0), np.abs(y).max(initial=0))
        if self.size * (2 * int(most)) ** 2 < 1 << 31:
            x, y = x.astype(np.int32), y.astype(np.int32)
        so_far = np.zeros((len(x), len(y)), x.dtype)
        for j in range(done):
            gap = x[:, j, None] - y[None, :, j]
            gap *= gap
            so_far += gap
        best = so_far.argmin(axis=1)
        rest = x[:, done:] - y[best, done:]
        bound = so_far[np.arange(len(x)), best] + (rest * rest).sum(axis=1, dtype=x.dtype)
        open_ = np.flatnonzero(so_far <= bound[:, None])
        row, entry, value = open_ // len(y), open_ % len(y), so_far.ravel()[open_]
        while done < self.size:
            for j in range(done, done := min(done + THEN, self.size)):
                gap = x[:, j].take(row) - y[:, j].take(entry)
                value += gap * gap
            keep = np.flatnonzero(value <= bound.take(row))
            row, entry, value = row[keep], entry[keep], value[keep]
        # Rows rise, and entries rise within them: a stable order by value leaves the lowest of equals first.
        order = np.lexsort((entry, value, row))
        first = order[np.r_[True, row[order][1:] != row[order][:-1]]] if len(order) else order
        return entry[first], value[first]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to ``width``."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(I8)
    out = np.zeros((len(lengths), width), I8)
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def _kept(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, x): whole-number vectors of the rows that have no missing or non-finite component."""
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    vector = F.col(vector_col).cast("array<double>")
    return df.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), vector.alias("v")).filter(
        F.col("v").isNotNull() & ~F.coalesce(F.exists("v", bad), F.lit(False))).select(
        "vec_id", "label", F.transform("v", lambda v: F.floor(v * SCALE)).alias("x"))


def train(rows: DataFrame, parts: int, entries: int, rounds: int, width: int) -> list[np.ndarray]:
    """Codebooks after ``rounds`` of assigning all parts and averaging; ``rows`` is stored and has ``x``.

    Every task adds up its own parts per entry; Spark adds up the tasks. Only sums of parts x entries rows come back.
    """
    spark = rows.sparkSession
    first = rows.orderBy(F.col("vec_id").isNull(), "vec_id", "x").limit(entries).collect()
    seed = np.zeros((len(first), parts * width), I8)
    for i, r in enumerate(first):
        seed[i, :len(r.x)] = r.x
    books = [seed[:, p * width:(p + 1) * width] for p in range(parts)]
    total = F.array(*[F.sum(F.col("total")[i]) for i in range(width)]) if width else F.array().cast("array<long>")
    for _ in range(rounds if len(seed) else 0):
        shared = spark.sparkContext.broadcast(books)  # parts x entries x width numbers, whatever the table

        def add(batches):
            found = [Codebook(b) for b in shared.value]
            count = np.zeros((parts, len(seed)), np.int64)
            sums = np.zeros((parts, len(seed), width), I8)
            for batch in batches:
                x = _matrix(batch.column("x"), parts * width)
                for p, book in enumerate(found):
                    part = x[:, p * width:(p + 1) * width]
                    at, _ = book.nearest(part)
                    count[p] += np.bincount(at, minlength=len(seed))
                    np.add.at(sums[p], at, part)
            p, e = np.nonzero(count)
            yield pa.record_batch({"part": pa.array(p, pa.int32()), "entry": pa.array(e, pa.int32()), "n": pa.array(count[p, e]),
                                   "total": pa.array(list(sums[p, e]), pa.list_(pa.int64()))})

        moved = rows.select("x").mapInArrow(add, "part int, entry int, n long, total array<long>")
        books = [b.copy() for b in books]
        for r in moved.groupBy("part", "entry").agg(F.sum("n").alias("n"), total.alias("total")).collect():
            books[r.part][r.entry] = np.array(r.total, I8) // r.n
        shared.unpersist()
    return books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position, with commas between."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def encode(rows: DataFrame, books: list[np.ndarray], width: int) -> DataFrame:
    """(vec_id, label, code, error): nearest entries of all parts, two hex digits each, and the squared distances' sum."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    parts = len(books)

    def run(batches):
        found = [Codebook(b) for b in shared.value]
        for batch in batches:
            x = _matrix(batch.column("x"), parts * width)
            both = [book.nearest(x[:, p * width:(p + 1) * width]) for p, book in enumerate(found)]
            index = np.stack([a for a, _ in both], axis=1).astype(np.uint8)
            yield pa.record_batch({
                "vec_id": batch.column("vec_id"), "label": batch.column("label"),
                "code": pa.array([r.tobytes().hex() for r in index], pa.string()),
                "error": pa.array(sum(d for _, d in both), pa.int64())})

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def compress(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id",
             vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """One row per kept row of ``df`` (vec_id, label, code, error, label_error), and the codebooks.

    A component x counts as floor(1024 * x), in whole numbers from there on. Vectors are cut into ``parts`` equal
    consecutive parts. The codebook of a part position starts as that part of the vectors with the ``entries``
    (at most 256) smallest ids and is moved ``rounds`` times: every part goes to its nearest entry (lowest index of
    equals), every entry to its parts' floored mean, unused entries stay. ``label_error`` adds up the errors of equal labels.

    Rows whose vector is null or has a null or non-finite component are left out. A vector shorter than the longest is
    filled up with zeros, and so is a length that the parts do not divide; empty vectors count as zeros. Null ids come
    last, equal ids in the order of their vectors; repeated rows all count. Null labels are one label. With fewer rows
    than entries the codebooks are shorter. An empty table gives no rows. Components beyond ``largest`` would leave 64 bits
    and stop the job. Other columns are not read.

    The whole-number vectors are stored once and read ``rounds + 1`` times; what goes to all tasks is parts x entries x
    width numbers. An error is kept per row before labels are added up, and labels come back by a join on their short table.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits for each part: 1 to 256 entries")
    rows = settle(_kept(df, id_col, vector_col, label_col))
    # The greatest size of a component, taken apart from its sign so that none is missed at the limits of 64 bits.
    longest, low, high = rows.agg(F.max(F.size("x")), F.min(F.array_min("x")), F.max(F.array_max("x"))).first()
    width = -(-(longest or 0) // parts)
    if max(-(low or 0), high or 0) > largest(width):
        raise ValueError(f"components beyond {largest(width) / SCALE} do not fit exact 64-bit sums")
    books = train(rows, parts, entries, rounds, width)
    coded = settle(encode(rows, books, width))
    per_label = settle(coded.groupBy("label").agg(F.sum("error").alias("label_error")))
    a, b = coded.alias("a"), per_label.alias("b")
    return a.join(b, F.col("a.label").eqNullSafe(F.col("b.label"))).select("a.*", "b.label_error"), books
