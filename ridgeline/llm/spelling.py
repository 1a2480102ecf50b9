"""Spelling variants: edits are probed against Bloom filters, and what they let through meets the exact vocabulary."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm import kernels as kn
from ridgeline.llm.common import settings
from ridgeline.session import settle

LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
#: Of a filter: bits for each word, bits set by a word inside its block of 512, and the bytes sent to all tasks at once.
BITS, SET, MOST_BYTES = 16, 7, 32 << 20
BLOCK_WORDS = 8  # 64-bit words of a block
#: Edits that are looked at in one array step, and words whose edits one task looks at.
STEP, TASK_WORDS = 1 << 18, 20_000

# A letter is one of U+0041-5A, U+0061-7A, U+00C0-FF, so a run of letters is one byte each in Latin-1; others become a space.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 192 else 32 for c in range(256))


def letter_runs(text: str | None) -> list[bytes]:
    """Runs of letters of the whole text in Latin-1, A-Z in lower case."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split() if text else []


def typed(run: bytes, doc_id: bytes) -> bytes:
    """The run as this document spells it: where 31 divides its checksum, without one letter."""
    h = zlib.crc32(run.decode("latin-1").encode(), zlib.crc32(doc_id + b":"))
    if h % 31:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
               least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): letter runs as the documents spell them, of ``least_length`` letters and ``least_count`` occurrences at least.

    Tasks count their own texts and hand on a word when they hold many; Spark adds up.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        held: Counter[bytes] = Counter()

        def out():
            words = [w.decode("latin-1") for w in held]
            return pa.record_batch({"word": pa.array(words, pa.string()), "n": pa.array(list(held.values()), pa.int64())})

        for batch in batches:
            for part in kn.pieces(batch, "text"):
                for doc_id, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                    doc_id = doc_id.encode()
                    for x, n in Counter(w for w in letter_runs(text) if len(w) >= least_length).items():
                        x = typed(x, doc_id)
                        if len(x) >= least_length:
                            held[x] += n
                    if len(held) >= kn.MOST_WORDS_KEPT:
                        yield out()
                        held.clear()
        yield out()

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def letter_hash(place: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """64 bits for a letter (its byte) at a place; a word's hash is those of its letters, combined by exclusive or."""
    return kn.mixed((place.astype(np.uint64) << np.uint64(8) | letter.astype(np.uint64)) * kn.ODD + np.uint64(1))


def block_of(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each hash, and the bits from which its places in the block are taken."""
    g = kn.mixed(h)
    return (((g >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64), kn.mixed(g)


def place_of(low: np.ndarray, i: int) -> np.ndarray:
    """The i-th of the places (0 to 511) of each hash in its block."""
    return (low >> np.uint64(9 * i)) & np.uint64(511)


def bits_of(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit words of a filter that the hashes touch, and the bits to set in them."""
    block, low = block_of(h, blocks)
    place = np.concatenate([place_of(low, i) for i in range(SET)])
    at = np.tile(block * BLOCK_WORDS, SET) + (place >> np.uint64(6)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    at, one = at[order], (np.uint64(1) << (place & np.uint64(63)))[order]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, np.int64)
    return at[first], np.bitwise_or.reduceat(one, first) if len(first) else one


def let_through(table: np.ndarray, start: int, blocks: int, h: np.ndarray) -> np.ndarray:
    """Which hashes have all their places set in the filter that begins at block ``start`` of the table."""
    block, low = block_of(h, blocks)
    at, alive = (block + start) * BLOCK_WORDS, np.arange(len(h))
    for i in range(SET):
        place = place_of(low, i)
        ok = np.flatnonzero((table[at + (place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1))
        at, low, alive = at[ok], low[ok], alive[ok]
    return alive


class Shard:
    """Where in the table of one pass the filter of one length, or of a slice of that length, lies."""

    def __init__(self, length: int, piece: int, pieces: int, start: int, blocks: int):
        self.length, self.piece, self.pieces, self.start, self.blocks = length, piece, pieces, start, blocks

    def mine(self, h: np.ndarray) -> np.ndarray:
        return kn.mixed(h ^ kn.ODD) % np.uint64(self.pieces) == np.uint64(self.piece)


def passes(counts: dict[int, int], most_bytes: int) -> list[list[tuple[int, int, int, int, int]]]:
    """Filters (length, piece, pieces, start, blocks) for words of each length, in passes of at most ``most_bytes``.

    A length with more words than one pass can hold is cut into pieces by hash; every word is in one filter of one pass.
    """
    most = max(most_bytes // (BLOCK_WORDS * 8), 1)
    out, now, used = [], [], 0
    for length, n in sorted(counts.items()):
        blocks = -(-n * BITS // 512)
        pieces = -(-blocks // most)
        blocks = -(-blocks // pieces)
        for piece in range(pieces):
            if used + blocks > most and now:
                out.append(now)
                now, used = [], 0
            now.append((length, piece, pieces, used, blocks))
            used += blocks
    return [*out, now] if now else out


def by_length(words: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Row numbers and letters (rows, places) of the words of each length."""
    lengths = np.array([len(w) for w in words], np.int64)
    out = {}
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        out[n] = at, np.frombuffer(b"".join(words[i] for i in at), np.uint8).reshape(len(at), n)
    return out


def hashes(letters: np.ndarray) -> np.ndarray:
    """Hash of each letter at its place (rows, places)."""
    return letter_hash(np.arange(letters.shape[1])[None, :], letters)


def _filters(words: DataFrame, plan: list) -> np.ndarray:
    """The filters of one pass: tasks set bits, Spark ORs 64-bit words of the table; its size is that of the pass."""
    def run(batches):
        shards = [Shard(*x) for x in plan]
        for batch in batches:
            at, bits = [], []
            for n, (_, letters) in by_length([w.encode("latin-1") for w in batch.column(0).to_pylist()]).items():
                h = np.bitwise_xor.reduce(hashes(letters), axis=1)
                for s in shards:
                    if s.length == n:
                        some, set_ = bits_of(h[s.mine(h)], s.blocks)
                        at.append(some + s.start * BLOCK_WORDS)
                        bits.append(set_)
            if at:
                yield pa.record_batch({"at": pa.array(np.concatenate(at)), "bits": pa.array(np.concatenate(bits).view(np.int64))})

    found = words.select("word").mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(sum(x[4] for x in plan) * BLOCK_WORDS, np.uint64)
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _edits(letters: np.ndarray, alphabet: np.ndarray):
    """Hashes of edits of equally long words, step by step: (hash (rows, edits), place, letter); letter 0 is a deletion.

    A longer word finds the shorter one by a deletion, and of two of one length that with the earlier letter finds
    the other by a replacement, so each pair is found once but for runs of one letter, of which the first is deleted.
    """
    rows, n = letters.shape
    here = hashes(letters)
    whole = np.bitwise_xor.reduce(here, axis=1)
    # Without place i: the letters before it as they are, those after it one place further left.
    left = letter_hash(np.arange(n - 1)[None, :], letters[:, 1:])
    before = np.bitwise_xor.accumulate(here, axis=1)
    after = np.bitwise_xor.accumulate(left[:, ::-1], axis=1)[:, ::-1]
    shorter = np.zeros((rows, n), np.uint64)
    shorter[:, 1:] ^= before[:, :-1]
    shorter[:, :-1] ^= after
    first = np.ones((rows, n), bool)
    first[:, 1:] = letters[:, 1:] != letters[:, :-1]
    yield n - 1, shorter, first, np.arange(n), np.zeros(n, np.uint8)
    wide = max(STEP // max(rows * len(alphabet), 1), 1)
    for i in range(0, n, wide):
        place = np.repeat(np.arange(i, min(i + wide, n)), len(alphabet))
        letter = np.tile(alphabet, min(i + wide, n) - i)
        new = whole[:, None] ^ here[:, place] ^ letter_hash(place, letter)[None, :]
        yield n, new, letter[None, :] > letters[:, place], place, letter


def _probed(words: DataFrame, plan: list, shared) -> DataFrame:
    """(edit, word, n): edits of the words that a filter of this pass lets through; true ones always."""
    def run(batches):
        filters, alphabet = shared.value
        shards = [Shard(*x) for x in plan]

        def found(words, number, letters):
            for n, h, able, place, letter in _edits(letters, alphabet):
                for s in (s for s in shards if s.length == n):
                    row, col = np.nonzero(able & s.mine(h) if s.pieces > 1 else able)
                    for k in range(0, len(row), STEP):
                        r, c = row[k:k + STEP], col[k:k + STEP]
                        hit = let_through(filters, s.start, s.blocks, h[r, c])
                        for i, e in zip(r[hit].tolist(), c[hit].tolist()):
                            w, p = words[number[i]], int(place[e])
                            yield number[i], w[:p] + (bytes([letter[e]]) if letter[e] else b"") + w[p + 1:]

        for batch in batches:
            words = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            at, edit = [], []
            for n, (number, letters) in by_length(words).items():
                rows = max(STEP // n, 1)
                for i in range(0, len(letters), rows):
                    for a, e in found(words, number[i:i + rows], letters[i:i + rows]):
                        at.append(a)
                        edit.append(e.decode("latin-1"))
                        if len(at) >= 1 << 16:
                            yield _found(batch, at, edit)
                            at, edit = [], []
            yield _found(batch, at, edit)

    return words.mapInArrow(run, "edit string, word string, n long")


def _found(batch: pa.RecordBatch, at: list[int], edit: list[str]) -> pa.RecordBatch:
    pick = pa.array(at, pa.int64())
    return pa.record_batch({"edit": pa.array(edit, pa.string()), "word": batch.column("word").take(pick), "n": batch.column("n").take(pick)})


def near_pairs(words: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(word, n, near, near_n): all pairs of stored ``words`` (word, n) that one inserted, deleted or replaced letter tells apart, both ways.

    Filters of all words would grow with the vocabulary, so they are made and sent in passes of bounded size; in
    each pass every word's edits are probed. Only what the filters let through is shuffled, to an exact join.
    """
    found = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct().collect()  # 90 letters at most
    alphabet = np.array(sorted(ord(r.c) for r in found if r.c), np.uint8)
    counts = {r.length: r.n for r in words.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()}
    edits = words.select(F.col("word").alias("edit"), F.col("n").alias("edit_n"))
    # A word is a few bytes and a thousand edits, so the work is dealt out by words, not by the size of their file.
    dealt = words.repartition(max(1, -(-sum(counts.values()) // TASK_WORDS)))
    once = words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    for plan in passes(counts, most_bytes):
        shared = words.sparkSession.sparkContext.broadcast((_filters(words, plan), alphabet))  # most_bytes and 90 letters at most
        some = settle(_probed(dealt, plan, shared).join(edits, "edit").select("word", "n", F.col("edit").alias("near"), F.col("edit_n").alias("near_n")))
        shared.unpersist()
        once = once.unionByName(some)
    return once.unionByName(once.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def roots(links: DataFrame, most_rounds: int = 12) -> DataFrame:
    """(word, root) of stored ``links`` (word, form): forms followed to the last, twice as far in every round.

    Along a chain the count rises tenfold, so a chain is short: 19 words in 64-bit counts.
    """
    now = links.select("word", F.col("form").alias("root"))
    for _ in range(most_rounds):
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        now = settle(now.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        if now.filter("_moved").isEmpty():
            return now.drop("_moved")
        now = now.drop("_moved")
    raise RuntimeError(f"forms still change after {most_rounds} rounds")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
             times: int = TIMES, most_bytes: int = MOST_BYTES) -> DataFrame:
    """One row per word of ``docs``: word, form, root, n, n_near, form_n.

    Words are the runs of letters (U+0041-5A, U+0061-7A, U+00C0-FF; A-Z in lower case) as ``typed`` leaves them, of
    at least ``least_length`` letters that occur ``least_count`` times. Two words are near if one inserted, deleted or
    replaced letter tells them apart. A word's form is its commonest near word (of equals the first in code-point order) if that
    occurs ``times`` times as often; its root is the last form that forms lead to, or itself. n_near counts near words.

    Null and empty texts have no words; a null id counts as empty. Repeated rows count again. Very long texts are
    whole, and so are very long runs. No words give no rows. Other columns are not read.
    """
    if times < 2:
        raise ValueError("a form must be at least twice as common, or forms could go in a circle")
    # All that runs Python is stored inside; a batch holds a thousand texts at most.
    with settings(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}):
        words = settle(vocabulary(docs, id_col, text_col, least_length, least_count))
    pairs = near_pairs(words, most_bytes)
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near")))
    near = settle(pairs.groupBy("word").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.when(-F.col("best.m") >= times * F.col("n"), F.struct(F.col("best.near").alias("form"), (-F.col("best.m")).alias("form_n"))).alias("f")))
    ends = roots(settle(near.filter("f IS NOT NULL").select("word", F.col("f.form").alias("form"))))
    return words.join(near, "word", "left").join(ends, "word", "left").select(
        "word", F.col("f.form").alias("form"), F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.col("f.form_n").alias("form_n"))
