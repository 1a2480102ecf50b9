"""Katz backoff language model of any order: counted, stored and evaluated part by part.

A part is a run of documents of one input split. For each part these things happen in tasks:

1. its distinct words are asked for, bucket by bucket; a bucket adds up what all parts say of a
   word and answers each part with the word's count and number;
2. its distinct word pairs are asked for in the same way, a pair being the number of its history and that of
   its word; a bucket holds all pairs of a history, so it also knows what the backoff weight of that history needs;
3. the same for three words, the history being the number of the pair before the last word, and so on up to the order;
4. its texts are evaluated with the stored answers, token by token, backing off order by order.

So what is shuffled are distinct n-grams of a part, never single tokens, and nothing is
sent to all tasks but a few totals and the histories that were spread over buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm import kernels as kn
from ridgeline.llm.common import scratch, settings, text_or_empty
from ridgeline.session import settle

MOST = 5                 # counts up to this are discounted by Good-Turing
GIVEN = 0.05             # what a larger count gives up, so that every history leaves something to unseen words
PART_TOKENS = 1_000_000  # shared out over the orders from two on
BUCKET_BYTES = 8 << 20   # text per bucket
START, END = np.uint64(1), np.uint64(2)
BASE = 0.1


# Arrays in rows: bytes of equal weight side by side, so that the zero bytes of small numbers are packed well.

def packed(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() if len(x) else b""


def unpacked(b: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).view(kind).ravel() if b else np.zeros(0, kind)


# Parts

@dataclass
class Part:
    name: str
    ids: list
    train: np.ndarray    # per document
    words: np.ndarray    # distinct word hashes, END included, sorted
    tokens: np.ndarray   # places in ``words``, END after each document
    ends: np.ndarray     # per document, where its tokens end

    def counts(self) -> np.ndarray:
        """How often each distinct word occurs in training documents."""
        sizes = np.diff(np.r_[0, self.ends])
        return np.bincount(self.tokens[np.repeat(self.train, sizes)], minlength=len(self.words)).astype(np.uint32)


class Numbered(dict):
    """Numbers words in the order they come; END is 0."""

    def __init__(self):
        super().__init__({None: 0})

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def parts(batches: Iterator[pa.RecordBatch], order: int = 2) -> Iterator[Part]:
    """Documents of a split in order, cut where their tokens reach the size of a part."""
    most = PART_TOKENS // (order - 1)
    numbers, at, nth = Numbered(), None, 0
    ids, train, found, held = [], [], [], 0

    def part():
        lengths = [len(x) for x in found]
        own = (xxhash.xxh3_64_intdigest(w) for w in numbers if w is not None)
        # Only distinct words are hashed and sorted.
        words, place = np.unique(np.r_[END, np.fromiter(own, np.uint64, len(numbers) - 1)], return_inverse=True)
        return Part(f"{xxhash.xxh3_128_hexdigest(str(at))}-{nth}", list(ids), np.array(train, bool), words,
                    place[np.concatenate(found)], np.cumsum(lengths))

    for batch in batches:
        where = list(zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()))
        texts, known, flags = batch.column("text"), batch.column("doc_id"), batch.column("train").to_pylist()
        for i in range(batch.num_rows):
            if where[i] != at or held >= most:
                if found:
                    yield part()
                    numbers, ids, train, found, held = Numbered(), [], [], [], 0
                nth = nth + 1 if where[i] == at else 0
                at = where[i]
            words = kn.space_words(texts[i].as_py())
            words.append(None)
            ids.append(known[i].as_py())
            train.append(flags[i])
            found.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
            held += len(words)
    if found:
        yield part()


def answers(folder: str, name: str) -> list[dict]:
    fs, at = pafs.FileSystem.from_uri(folder)
    return pq.read_table(f"{at}/part={name}", filesystem=fs, partitioning=None).sort_by("bucket").to_pylist()


def _record(columns: dict) -> pa.RecordBatch:
    return pa.record_batch({k: pa.array(v, kind) for k, (v, kind) in columns.items()})


# Words

def word_requests(docs: DataFrame, bits: int, order: int) -> DataFrame:
    """(part, bucket, words, n): the distinct words of a part, cut by their first ``bits`` bits."""
    def run(batches):
        for p in parts(batches, order):
            n = p.counts()
            cut = np.searchsorted(p.words, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.array([0])
            cut = np.r_[cut, len(p.words)]
            full = [b for b in range(1 << bits) if cut[b + 1] > cut[b]]
            yield _record({"part": ([p.name] * len(full), pa.string()), "bucket": (full, pa.int64()),
                           "words": ([packed(p.words[cut[b]:cut[b + 1]]) for b in full], pa.binary()),
                           "n": ([packed(n[cut[b]:cut[b + 1]]) for b in full], pa.binary())})

    return docs.mapInArrow(run, "part string, bucket long, words binary, n binary")


def _stats(count: np.ndarray) -> dict:
    """Count of counts, as columns that are filled in one row of a bucket."""
    return {f"r{r}": int((count == r).sum()) for r in range(1, MOST + 2)} | {"distinct": int((count > 0).sum()), "total": int(count.sum())}


STATS = [f"r{r}" for r in range(1, MOST + 2)] + ["distinct", "total"]
STATS_SCHEMA = ", ".join(f"{s} long" for s in STATS)


def _stat_columns(first: dict, n: int) -> dict:
    return {s: ([first[s]] + [0] * (n - 1), pa.int64()) for s in STATS}


def word_answers(requests: DataFrame) -> DataFrame:
    """Each request with the whole corpus's count of every word, and the word's place in its bucket."""
    def run(key, table):
        rows = table.to_pylist()
        words = [unpacked(r["words"], np.uint64) for r in rows]
        every, place = np.unique(np.concatenate(words), return_inverse=True)
        n = np.concatenate([unpacked(r["n"], np.uint32) for r in rows]).astype(np.float64)
        count = np.bincount(place, weights=n, minlength=len(every)).astype(np.uint64)
        cut = np.cumsum([0] + [len(w) for w in words])
        seen = [place[cut[i]:cut[i + 1]] for i in range(len(rows))]
        return pa.Table.from_batches([_record({
            "part": ([r["part"] for r in rows], pa.string()), "bucket": ([r["bucket"] for r in rows], pa.int64()),
            "count": ([packed(count[s]) for s in seen], pa.binary()), "place": ([packed(s.astype(np.uint64)) for s in seen], pa.binary()),
            **_stat_columns(_stats(count), len(rows))})])

    return requests.groupBy("bucket").applyInArrow(lambda k, t: run(k, t), f"part string, bucket long, count binary, place binary, {STATS_SCHEMA}")


def numbered(bucket: int, place: np.ndarray) -> np.ndarray:
    """Numbers of the n-grams of a bucket by their places in it; 0 is the start of a text."""
    return (np.uint64(bucket) << np.uint64(40)) + place + np.uint64(1)


def _stored(answered: DataFrame, name: str) -> tuple[DataFrame, str]:
    """A table with one folder per part, which holds all the part will need."""
    folder = scratch(answered.sparkSession, name)
    answered.repartition("part").write.partitionBy("part").parquet(folder)
    return answered.sparkSession.read.schema(answered.schema).parquet(folder), folder


# Discounts

def discounts(r: list[int]) -> np.ndarray:
    """Katz's factors for counts 1 to 5 from the number of n-grams that occur r = 1 to 6 times.

    Good-Turing estimates where they give falling, proper discounts; else the absolute discount that the
    first two numbers suggest, as on small or odd tables.
    """
    r = [float(x) for x in r]
    if min(r) > 0:
        share = (MOST + 1) * r[MOST] / r[0]
        d = np.array([((i + 1) * r[i] / (i * r[i - 1]) - share) / (1 - share) if share < 1 else 0.0 for i in range(1, MOST + 1)])
        if (d > 0).all() and (d < 1).all():
            return d
    one = r[0] / (r[0] + 2 * r[1]) if r[0] > 0 and r[1] > 0 else 0.5
    return np.array([1 - min(max(one, 0.1), 0.9) / i for i in range(1, MOST + 1)])


def discounted(count: np.ndarray, factor: np.ndarray) -> np.ndarray:
    every = np.r_[0.0, factor, 1.0]
    return count * every[np.minimum(count, MOST + 1).astype(np.int64)] - GIVEN * (count > MOST)


def given_up(low: np.ndarray, high: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """What discounting takes away: ``low[..., r - 1]`` n-grams that occur r times, ``high`` more frequent ones."""
    return low @ ((1 - factor) * np.arange(1, MOST + 1)) + GIVEN * high


@dataclass
class Unigrams:
    total: int
    distinct: int
    factor: np.ndarray
    unseen: float        # probability of any word that training lacks, all such words being one

    @classmethod
    def of(cls, s: dict) -> "Unigrams":
        low = np.array([s[f"r{r}"] for r in range(1, MOST + 1)], float)
        factor = discounts([s[f"r{r}"] for r in range(1, MOST + 2)])
        lost = float(given_up(low, np.float64(s["distinct"] - low.sum()), factor))
        return cls(s["total"], s["distinct"], factor, lost / s["total"] if s["total"] else 1.0)

    def p(self, count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, discounted(count, self.factor) / max(self.total, 1), self.unseen)

    def base(self, count: np.ndarray) -> np.ndarray:
        return (count + BASE) / (self.total + BASE * (self.distinct + 1))


# Longer n-grams

@dataclass
class Grams:
    """The distinct n-grams of one order in a part."""

    of_token: np.ndarray   # the n-gram that ends at each token
    first: np.ndarray      # a token at which each ends
    history: np.ndarray    # number of its history
    after: np.ndarray      # how often that occurs in training
    word: np.ndarray       # place of its word in the part's words
    bucket: np.ndarray
    order: np.ndarray      # by bucket, then history


def grams(p: Part, history: np.ndarray, after: np.ndarray, ids: np.ndarray, bits: int, hot: int) -> Grams:
    """``history`` and ``after`` are per token; a hot history's n-grams go to buckets by their word too, all others by the history."""
    names, local = np.unique(history, return_inverse=True)
    _, first, of_token = np.unique((local.astype(np.uint64) << np.uint64(32)) | p.tokens.astype(np.uint64), return_index=True, return_inverse=True)
    h, often, word = history[first], after[first], p.tokens[first]
    spread = kn.mixed(h + np.where(often > hot, kn.mixed(ids[word] + np.uint64(1)), np.uint64(0)))
    bucket = (spread >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
    return Grams(of_token, first, h, often, word, bucket, np.argsort(bucket, kind="stable"))


def shifted(p: Part, x: np.ndarray, start: int) -> np.ndarray:
    """What the token before has; ``start`` at the first token of a text."""
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[np.r_[0, p.ends[:-1]]] = start
    return out


@dataclass
class Order:
    """What the tasks need of an order that has been answered: where its answers are, and its discounts."""

    folder: str
    factor: np.ndarray
    spread: object = None  # broadcast numbers and sums of spread histories


class Walk:
    """A part on its way through the orders: per token the count and the number of the n-gram that ends there, and its probability."""

    def __init__(self, p: Part, words: str, unigrams: "Unigrams", documents: int, bits: int, hot: int):
        self.p, self.bits, self.hot, self.documents = p, bits, hot, documents
        rows = answers(words, p.name)
        known = np.concatenate([unpacked(r["count"], np.uint64) for r in rows])
        self.ids = np.concatenate([numbered(r["bucket"], unpacked(r["place"], np.uint64)) for r in rows])
        if len(known) != len(p.words):
            raise ValueError(f"part {p.name} has changed since its words were counted")
        self.known = known
        self.count, self.number = known[p.tokens], self.ids[p.tokens]
        self.after = np.full(len(p.tokens), unigrams.total, np.uint64)
        self.prob = unigrams.p(known)[p.tokens]

    def grams(self) -> Grams:
        """N-grams of the next order; their histories are the n-grams that end a token earlier."""
        self.history, self.often = shifted(self.p, self.number, 0), shifted(self.p, self.count, self.documents)
        return grams(self.p, self.history, self.often, self.ids, self.bits, self.hot)

    def on(self, g: Grams, order: Order, unseen: float) -> None:
        """Go on to that order with its stored answers."""
        rows = answers(order.folder, self.p.name)
        c = np.concatenate([unpacked(r["count"], np.uint64) for r in rows])
        if len(c) != len(g.first):
            raise ValueError(f"part {self.p.name} has changed since its n-grams were counted")
        number = [numbered(r["bucket"], unpacked(r["place"], np.uint64)) for r in rows]
        history, bucket = g.history[g.order], g.bucket[g.order]
        # The histories of a bucket in the order of the request, those to back off from marked.
        first = np.r_[True, (history[1:] != history[:-1]) | (bucket[1:] != bucket[:-1])]
        off = np.concatenate([unpacked(r["off"], np.uint8) for r in rows]) > 0
        mass = np.zeros((len(off), MASS))
        mass[off] = np.concatenate([unpacked(r["mass"], np.float64) for r in rows]).reshape(-1, MASS)
        names, sums = order.spread.value
        if len(names):
            own = history[first]
            at = np.minimum(np.searchsorted(names, own), len(names) - 1)
            is_hot = (names[at] == own) & (g.after[g.order][first] > self.hot)
            mass[is_hot] = sums[at[is_hot]]
        left = given_up(mass[:, :MOST], mass[:, MOST], order.factor) / np.maximum(mass[:, MOST + 1], 1)
        alpha = np.where(mass[:, MOST + 1] > 0, left / np.maximum(1 - mass[:, MOST + 2], unseen), 1.0)
        prob = np.where(c > 0, discounted(c, order.factor) / np.maximum(g.after[g.order], 1),
                        alpha[np.cumsum(first) - 1] * self.prob[g.first[g.order]])
        back = np.empty(len(c), np.int64)
        back[g.order] = np.arange(len(c))
        of_token = back[g.of_token]
        self.after, self.prob, self.count = self.often, prob[of_token], c[of_token]
        self.number = np.concatenate(number)[of_token] if len(number[0]) else None  # the last order has no numbers


#: What a history's backoff weight needs: n-grams that occur 1 to 5 times, and more often, all tokens after it, and what
#: its words have after the shorter history.
MASS = MOST + 3
COLUMNS = ["histories", "hot", "bases", "runs", "words", "n", "count"]


def _walked(p: Part, words: str, lower: list[Order], unigrams: "Unigrams", documents: int, bits: int, hot: int) -> Walk:
    walk = Walk(p, words, unigrams, documents, bits, hot)
    for order in lower:
        walk.on(walk.grams(), order, TINY)
    return walk


#: Least share that discounting leaves; keeps a division from rounding.
TINY = 1e-15


def gram_requests(docs: DataFrame, words: str, lower: list[Order], unigrams: "Unigrams", bits: int, documents: int, hot: int, parts_for: int) -> DataFrame:
    """Distinct n-grams of a part by bucket: histories, which of them are hot, how often the shorter ones occur, n-grams of each, words,
    training counts, and counts of the n-grams without their first word."""
    def run(batches):
        for p in parts(batches, parts_for):
            walk = _walked(p, words, lower, unigrams, documents, bits, hot)
            g = walk.grams()
            flags = np.repeat(p.train, np.diff(np.r_[0, p.ends]))
            n = np.bincount(g.of_token[flags], minlength=len(g.first)).astype(np.uint32)[g.order]
            at = g.first[g.order]
            bucket, history, often, word = g.bucket[g.order], g.history[g.order], g.after[g.order], walk.ids[g.word[g.order]]
            shorter, base = walk.count[at], walk.after[at]
            cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
            out = []
            for a, b in zip(cut[:-1], cut[1:]):
                own = a + np.flatnonzero(np.r_[True, history[a + 1:b] != history[a:b - 1]])
                out.append((int(bucket[a]), packed(history[own]), packed((often[own] > hot).astype(np.uint8)), packed(base[own]),
                            packed(np.diff(np.r_[own, b]).astype(np.uint32)), packed(word[a:b]), packed(n[a:b]), packed(shorter[a:b])))
                if len(out) == 64:
                    yield _gram_batch(p.name, out)
                    out = []
            if out:
                yield _gram_batch(p.name, out)

    return docs.mapInArrow(run, "part string, bucket long, " + ", ".join(f"{c} binary" for c in COLUMNS))


def _gram_batch(name: str, out: list) -> pa.RecordBatch:
    return _record({"part": ([name] * len(out), pa.string()), "bucket": ([o[0] for o in out], pa.int64())}
                   | {k: ([o[i + 1] for o in out], pa.binary()) for i, k in enumerate(COLUMNS)})


def gram_answers(requests: DataFrame, lower: np.ndarray, last: bool) -> DataFrame:
    """Each request with the whole corpus's count of every n-gram, its place in the bucket unless this is the ``last`` order, and the sums
    of those histories that some text backs off from. ``lower`` are the discounts of the order below."""
    def run(key, table):
        rows = table.to_pylist()
        runs = [unpacked(r["runs"], np.uint32) for r in rows]
        history = [np.repeat(unpacked(r["histories"], np.uint64), k) for r, k in zip(rows, runs)]
        base = np.concatenate([np.repeat(unpacked(r["bases"], np.uint64), k) for r, k in zip(rows, runs)])
        cut = np.cumsum([0] + [len(h) for h in history])
        histories, h = np.unique(np.concatenate(history), return_inverse=True)
        _, w = np.unique(np.concatenate([unpacked(r["words"], np.uint64) for r in rows]), return_inverse=True)
        gram, first, place = np.unique((h.astype(np.uint64) << np.uint64(32)) | w.astype(np.uint64), return_index=True, return_inverse=True)
        n = np.concatenate([unpacked(r["n"], np.uint32) for r in rows]).astype(np.float64)
        count = np.bincount(place, weights=n, minlength=len(gram)).astype(np.uint64)
        shorter = np.concatenate([unpacked(r["count"], np.uint64) for r in rows])[first]
        # An n-gram that training has is there without its first word as well, so this is its probability then.
        owner, p = h[first], discounted(shorter, lower) / np.maximum(base[first], 1)
        add = lambda value, which: np.bincount(owner[which], weights=value[which], minlength=len(histories))
        ones, seen = np.ones(len(gram)), count > 0
        mass = np.stack([add(ones, count == r) for r in range(1, MOST + 1)]
                        + [add(ones, count > MOST), add(count.astype(np.float64), seen), add(p, seen)], axis=1)
        out, spread = [], set()
        for i, r in enumerate(rows):
            mine = place[cut[i]:cut[i + 1]]
            own, hs = count[mine], unpacked(r["histories"], np.uint64)
            off = np.add.reduceat(own == 0, np.r_[0, np.cumsum(runs[i])[:-1]].astype(np.int64)) > 0
            out.append((packed(own), b"" if last else packed(mine.astype(np.uint64)), packed(off.astype(np.uint8)),
                        packed(mass[np.searchsorted(histories, hs[off])].ravel())))
            spread.update(hs[unpacked(r["hot"], np.uint8) > 0].tolist())
        # The sums of a spread history cover this bucket's share only; Spark adds them up.
        shares = [{"history": int(np.uint64(x).view(np.int64)), "mass": mass[np.searchsorted(histories, np.uint64(x))].tolist()} for x in sorted(spread)]
        return pa.Table.from_batches([_record({
            "part": ([r["part"] for r in rows], pa.string()), "bucket": ([r["bucket"] for r in rows], pa.int64()),
            "count": ([o[0] for o in out], pa.binary()), "place": ([o[1] for o in out], pa.binary()),
            "off": ([o[2] for o in out], pa.binary()), "mass": ([o[3] for o in out], pa.binary()),
            "spread": ([shares] + [[]] * (len(rows) - 1), pa.list_(pa.struct([("history", pa.int64()), ("mass", pa.list_(pa.float64()))]))),
            **_stat_columns(_stats(count), len(rows))})])

    return requests.groupBy("bucket").applyInArrow(
        lambda k, t: run(k, t), "part string, bucket long, count binary, place binary, off binary, mass binary, "
        f"spread array<struct<history:long,mass:array<double>>>, {STATS_SCHEMA}")


def _scores(docs: DataFrame, words: str, orders: list[Order], bits: int, unigrams: "Unigrams", documents: int, hot: int, id_kind: str) -> DataFrame:
    """Evaluate every text with the stored answers of its part."""
    def run(batches):
        for p in parts(batches, len(orders) + 1):
            walk = _walked(p, words, orders, unigrams, documents, bits, hot)
            start = np.r_[0, p.ends[:-1]]
            total = lambda x: np.add.reduceat(x, start)
            yield _record({"doc_id": (p.ids, None), "held_out": (~p.train, pa.bool_()), "n_tokens": (p.ends - start, pa.int64()),
                           "n_known": (total((walk.known[p.tokens] > 0).astype(np.int64)), pa.int64()),
                           "base_score": (total(np.log10(unigrams.base(walk.known))[p.tokens]), pa.float64()),
                           "score": (total(np.log10(walk.prob)), pa.float64())})

    return docs.mapInArrow(run, f"doc_id {id_kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")


def _spread(stored: DataFrame):
    """Broadcast numbers and sums of the histories that were spread over buckets: at most 2 ** 18."""
    shares = stored.select(F.explode("spread").alias("s")).groupBy("s.history").agg(
        F.array(*[F.sum(F.col("s.mass")[i]) for i in range(MASS)]).alias("mass")).collect()
    names = np.array([r.history for r in shares], np.int64).view(np.uint64)
    order = np.argsort(names)
    return stored.sparkSession.sparkContext.broadcast((names[order], np.array([r.mass for r in shares], float).reshape(-1, MASS)[order]))


def _sum_stats(stored: DataFrame) -> dict:
    return {k: v or 0 for k, v in stored.agg(*[F.sum(s).alias(s) for s in STATS]).first().asDict().items()}


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stored: bool = False, bucket_bytes: int = BUCKET_BYTES,
          hot: int | None = None, order: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model of the given ``order`` (2 or more) is learned from rows whose crc32(id as text) mod 10 is not 0:
    P(w | h) is the discounted count of h and w together over that of h if training has them, else the backoff weight of h times
    P(w | h without its first word), and so on down to P(w), which is discounted too and leaves the rest to all unknown words as one.
    Texts begin with as many start marks as a history has words. Backoff weights make the words after h sum to one exactly. Scores are log10 of the whole text's
    probability, its end included. Sums and counts cover all training rows.

    ``docs`` is stored first, unless ``stored`` says that it is a table as read from files; parts are
    runs of rows of one file split, and all passes split files alike, since settings that
    decide it are held fixed. A part that differs between passes stops the job. ``bucket_bytes`` is the text per
    bucket. A history with over ``hot`` tokens (2 ** 20, or the 2 ** 18th part of all tokens if that is more) is spread
    over buckets by the pair, and its few sums are added up afterwards.

    Null or empty text is its end alone. A null id counts as the empty text, so it is held out. Repeated
    rows and equal ids are rows of their own, counted each time. An empty table gives no rows;
    without training rows all words are unknown. Other columns are not read.
    """
    if order < 2:
        raise ValueError("the order is 2 or more")
    spark = docs.sparkSession
    base = docs if stored else settle(docs.select(F.col(id_col), F.col(text_col)))
    crc = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    rows = base.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), (crc % 10 != 0).alias("train"),
                       F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    # Splits must not depend on how many executors there are at the moment; a task holds one batch and one part.
    fixed = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
             "spark.sql.files.minPartitionNum": spark.conf.get("spark.sql.files.minPartitionNum", None) or str(spark.sparkContext.defaultParallelism)}
    with settings(spark, fixed):
        size, documents = rows.agg(F.sum(F.octet_length(text_or_empty("text")) + 1), F.count_if("train")).first()
        bits = max(0, int(np.ceil(np.log2(max((size or 0) / bucket_bytes, 1)))))
        word_table, words = _stored(word_answers(word_requests(rows, bits, order)), "katz-words")
        unigrams = Unigrams.of(_sum_stats(word_table))
        hot = hot if hot is not None else max(1 << 20, unigrams.total >> 18)
        orders: list[Order] = []
        for k in range(2, order + 1):
            asked = gram_requests(rows, words, list(orders), unigrams, bits, documents, hot, order)
            stored_grams, folder = _stored(gram_answers(asked, orders[-1].factor if orders else unigrams.factor, k == order), f"katz-{k}")
            s = _sum_stats(stored_grams)
            orders.append(Order(folder, discounts([s[f"r{r}"] for r in range(1, MOST + 2)]), _spread(stored_grams)))
        found = settle(_scores(rows, words, orders, bits, unigrams, documents, hot, dict(rows.dtypes)["doc_id"]))
    return found.withColumn("train_tokens", F.lit(unigrams.total).cast("long"))
