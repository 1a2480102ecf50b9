"""Toxic spans and document scores by a linear-chain conditional random field."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.llm import kernels as kn
from ridgeline.llm.common import received, sent, text_or_empty

#: Bounds of the sample of labelled rows that the model is fitted on; everything else covers all rows.
MOST_TOXIC, MOST_CLEAN, MOST_CHARS = 2000, 4000, 50_000
DIM = 1 << 18
PIECE = 32  # tokens of a training sequence
PREFIXES, SUFFIXES = (4, 5, 6), (4,)


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> list:
    """(text, label) of a bounded, seeded sample of labelled rows that are not held out.

    At most 2,000 toxic and 4,000 clean ids are chosen from the labels alone; a conflict of labels counts as toxic. Only their texts, of at most 50,000
    characters, come to the driver. Of rows that repeat an id the smallest such text is taken, so an id counts once.
    """
    marked = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter("id IS NOT NULL AND y IN (0, 1)")
              .filter(~held_out("id")).groupBy("id").agg(F.max("y").alias("y")))
    order = F.md5(F.col("id").cast("string"))
    chosen = marked.filter("y = 1").orderBy(order).limit(MOST_TOXIC).unionByName(
        marked.filter("y = 0").orderBy(order).limit(MOST_CLEAN))
    # Bounded by the two limits, whatever the size of the tables.
    few = F.broadcast(chosen)
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(
        F.length(F.coalesce("text", F.lit(""))).between(1, MOST_CHARS)).join(few, "id")
    once = found.groupBy("id").agg(F.min("text").alias("text"), F.max("y").alias("y")).orderBy("id")
    return [(r.text, r.y) for r in once.collect()]


def word_features(word: bytes) -> list[bytes]:
    """The word and its first and last letters; characters, so that no letter is cut."""
    w = word.decode("utf-8", "replace")
    return ([b"w" + word] + [b"p%d" % k + w[:k].encode() for k in PREFIXES if len(w) >= k]
            + [b"s%d" % k + w[-k:].encode() for k in SUFFIXES if len(w) >= k])


def buckets(word: bytes) -> list[int]:
    return [zlib.crc32(f) & (DIM - 1) for f in word_features(word)]


def toxic_features(texts: list[set[bytes]], y: np.ndarray) -> set[bytes]:
    """Words and prefixes that mark toxic documents: labels for tokens from labels of documents.

    A feature qualifies if it is far commoner in toxic than in clean documents; of these the
    one that explains most toxic documents still without any is taken, until none explains
    enough. Of equals the longer prefix is taken.
    """
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    if not n1 or not n0:
        return set()
    where, clean = defaultdict(list), Counter()
    for i, words in enumerate(texts):
        seen = {f for w in words for f in word_features(w) if f[:1] != b"s"}
        if y[i]:
            for f in seen:
                where[f].append(i)
        else:
            clean.update(f for f in seen)
    least = max(2, n1 // 400)
    able = {f: set(d) for f, d in where.items() if len(d) >= least and len(d) / n1 >= 20 * (clean[f] + 0.05) / n0}
    chosen, open_docs = set(), set(np.flatnonzero(y).tolist())
    rank = sorted(able, key=lambda f: (-len(able[f]), -len(f), f))
    while rank:
        best = max(rank, key=lambda f: (len(able[f] & open_docs), -clean[f], f[:1] != b"w", len(f), f))
        gain = able[best] & open_docs
        if len(gain) < least:
            break
        chosen.add(best)
        open_docs -= gain
        rank = [f for f in rank if f != best and len(able[f]) >= least and (able[f] & open_docs)]
    return chosen


class SideBySide:
    """Sequences of different lengths, longest first, so that each step in time is one array operation."""

    def __init__(self, parts: list[np.ndarray]):
        n = np.array([len(p) for p in parts], np.int64)
        order = np.argsort(-n, kind="stable")
        self.order = order[n[order] > 0]
        self.n = n[self.order]
        self.parts = len(parts)
        self.longest = int(self.n[0]) if len(self.n) else 0
        self.flat = np.concatenate([parts[i] for i in self.order]) if self.longest else np.zeros(0)
        self.start = np.r_[0, np.cumsum(self.n)[:-1]].astype(np.int64)[:len(self.n)]
        #: How many sequences are longer than t.
        self.alive = np.searchsorted(-self.n, -np.arange(self.longest), side="left")

    def chain(self, onward) -> list[np.ndarray]:
        """x[0] = value[0]; x[t] = value[t] + onward(x[t - 1])."""
        out = self.flat.copy()
        m = self.flat[self.start]
        for t in range(1, self.longest):
            at = self.start[:self.alive[t]] + t
            m[:len(at)] = out[at] = self.flat[at] + onward(m[:len(at)])
        found = [np.zeros(0)] * self.parts
        for i, a, k in zip(self.order.tolist(), self.start.tolist(), self.n.tolist()):
            found[i] = out[a:a + k]
        return found


class Crf:
    """Two states, 0 outside and 1 toxic. ``w`` scores state 1 of a token by its features; ``step[a, b]`` scores state b after a."""

    def __init__(self):
        self.w = np.zeros(DIM)
        self.bias = -3.0
        self.step = np.zeros((2, 2))
        self.a, self.b = 1.0, 0.0  # logistic scale of a document's log odds

    # Messages are log odds of state 1 against state 0.
    def onward(self, m: np.ndarray) -> np.ndarray:
        s = self.step
        return np.logaddexp(s[0, 1], s[1, 1] + m) - np.logaddexp(s[0, 0], s[1, 0] + m)

    def backward(self, m: np.ndarray) -> np.ndarray:
        s = self.step
        return np.logaddexp(s[1, 0], s[1, 1] + m) - np.logaddexp(s[0, 0], s[0, 1] + m)

    def marginals(self, e: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of state 1, and of each pair of neighbouring states, for padded rows (rows, time)."""
        rows, time = e.shape
        f, g = np.zeros_like(e), np.zeros_like(e)
        for t in range(time):
            f[:, t] = e[:, t] + (self.onward(f[:, t - 1]) if t else 0)
        for t in range(time - 2, -1, -1):
            g[:, t] = np.where(valid[:, t + 1], self.backward(e[:, t + 1] + g[:, t + 1]), 0)
        p = 1 / (1 + np.exp(-np.clip(f + g, -500, 500)))
        pair = np.zeros((rows, max(time - 1, 0), 2, 2))
        for x in (0, 1):
            for z in (0, 1):
                pair[:, :, x, z] = self.step[x, z] + x * f[:, :-1] + z * (e[:, 1:] + g[:, 1:])
        if time > 1:
            pair = np.exp(pair - pair.max(axis=(2, 3), keepdims=True))
            pair /= pair.sum(axis=(2, 3), keepdims=True)
        return p, pair

    def fit(self, at: np.ndarray, table: np.ndarray, n_features: np.ndarray, y: np.ndarray, rounds: int = 8, batch: int = 256, seed: int = 7) -> None:
        """Likelihood of labelled sequences by AdaGrad, in small batches of all of them.

        ``at`` holds numbers of words (rows, time), -1 after the end; ``table`` the feature buckets of each word,
        of which the first ``n_features`` count.
        """
        rng = np.random.default_rng(seed)
        gw, gs, gb = np.full(DIM, 1e-6), np.full((2, 2), 1e-6), 1e-6
        use = np.arange(table.shape[1]) < n_features[:, None]
        for _ in range(rounds):
            order = rng.permutation(len(y))
            for i in range(0, len(order), batch):
                r = order[i:i + batch]
                word, t = at[r], y[r]
                v = word >= 0
                x, ok = table[word], use[word] & v[:, :, None]
                e = (self.w[x] * ok).sum(axis=2) + self.bias
                p, pair = self.marginals(e, v)
                d = np.where(v, p - t, 0.0)
                grad = np.bincount(x[ok], weights=np.broadcast_to(d[:, :, None], ok.shape)[ok], minlength=DIM) / len(r)
                grad += 1e-6 * self.w
                both = v[:, 1:] & v[:, :-1]
                seen = np.zeros((2, 2))
                for a in (0, 1):
                    for b in (0, 1):
                        seen[a, b] = (pair[:, :, a, b][both].sum() - (both & (t[:, :-1] == a) & (t[:, 1:] == b)).sum()) / len(r)
                seen += 1e-4 * self.step
                gw += grad ** 2
                gs += seen ** 2
                gb += (d.sum() / len(r)) ** 2
                self.w -= 0.5 * grad / np.sqrt(gw)
                self.step -= 0.1 * seen / np.sqrt(gs)
                self.bias -= 0.1 * (d.sum() / len(r)) / np.sqrt(gb)

    def log_odds(self, emissions: list[np.ndarray]) -> np.ndarray:
        """Per text: log odds that at least one token is toxic, from the forward sums of all its tokens.

        ``toxic`` and ``past`` are log weights of the paths that are in state 1 now, and of those in
        state 0 that have been in 1 before, against the path that never was.
        """
        side = SideBySide(emissions)
        out = np.full(len(emissions), -30.0)
        if not side.longest:
            return out
        s = self.step
        toxic, past = side.flat[side.start], np.full(len(side.start), -np.inf)
        for t in range(1, side.longest):
            k = side.alive[t]
            e = side.flat[side.start[:k] + t]
            now = e + np.logaddexp(s[0, 1] + np.logaddexp(0.0, past[:k]), s[1, 1] + toxic[:k]) - s[0, 0]
            past[:k] = np.logaddexp(past[:k], s[1, 0] - s[0, 0] + toxic[:k])
            toxic[:k] = now
        out[side.order] = np.maximum(np.logaddexp(toxic, past), -30.0)
        return out

    def token_probabilities(self, emissions: list[np.ndarray]) -> list[np.ndarray]:
        """Marginal probability of state 1 for every token of every text."""
        forward = SideBySide(emissions).chain(self.onward)
        back = SideBySide([e[::-1] for e in emissions]).chain(self.backward)
        return [1 / (1 + np.exp(-np.clip(f + g[::-1] - e, -500, 500))) for f, g, e in zip(forward, back, emissions)]

    def calibrate(self, odds: np.ndarray, y: np.ndarray) -> None:
        """Logistic scale and shift by a few damped Newton steps, with weak pull to (1, 0)."""
        x = np.stack([np.clip(odds, -30, 30), np.ones(len(odds))], axis=1)
        v = np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-x @ v))
            g = x.T @ (p - y) + 0.1 * (v - [1.0, 0.0])
            h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
            v = v - np.clip(np.linalg.solve(h, g), -1, 1)
        self.a, self.b = max(float(v[0]), 1e-3), float(v[1])

    def probability(self, odds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * np.clip(odds, -30, 30) + self.b, -30, 30)))


class Emissions(dict):
    """Score of state 1 for a word, remembered; emptied when it has grown large."""

    def __init__(self, model: Crf):
        super().__init__()
        self.w, self.bias = model.w.tolist(), model.bias

    def __missing__(self, word: bytes) -> float:
        if len(self) >= kn.MOST_WORDS_KEPT:
            self.clear()
        value = self[word] = self.bias + sum(self.w[i] for i in buckets(word))
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.float64, count=len(words))


def train(rows: list) -> Crf:
    """Fit the model on all tokens of (text, label) pairs, as ``sample`` gives them: a bounded number.

    Texts are cut into pieces of 32 tokens, all of which are used. Without both labels the score is the share of toxic rows.
    """
    model = Crf()
    y = np.array([r[1] for r in rows], np.int64)
    words = [kn.plain_words(r[0]) for r in rows]
    marks = toxic_features([set(w) for w in words], y)
    if not marks:
        share = float(y.mean()) if len(y) else 0.0
        model.a, model.b = 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        return model
    # Every piece of every sampled text; words are numbered, so a piece is a row of numbers.
    number: dict[bytes, int] = {}
    for w in words:
        for x in w:
            number.setdefault(x, len(number))
    features = [buckets(x) for x in number]
    table = np.zeros((len(features), 1 + len(PREFIXES) + len(SUFFIXES)), np.int32)
    for i, b in enumerate(features):
        table[i, :len(b)] = b
    count = np.array([len(b) for b in features], np.int8)
    marked = np.array([any(f in marks for f in word_features(x)) for x in number], bool)
    at = np.full((sum(-(-len(w) // PIECE) for w in words), PIECE), -1, np.int32)
    tags, row = np.zeros(at.shape, bool), 0
    for w, label in zip(words, y):
        ids = np.array([number[x] for x in w], np.int32)
        for i in range(0, len(ids), PIECE):
            piece = ids[i:i + PIECE]
            at[row, :len(piece)] = piece
            if label:
                tags[row, :len(piece)] = marked[piece]
            row += 1
    model.fit(at, table, count, tags)
    score = Emissions(model)
    model.calibrate(np.concatenate([model.log_odds([score.of(w) for w in words[i:i + 500]]) for i in range(0, len(words), 500)]), y)
    return model


_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def spans(text: str, p: np.ndarray, least: float = 0.5) -> list[dict]:
    """Runs of tokens with a probability of at least ``least``: from and to in characters, highest probability."""
    raw = text.encode("utf-8", "surrogatepass")
    out, last = [], -2
    for i, m in enumerate(_WORD.finditer(raw.translate(kn._PLAIN))):
        if p[i] < least:
            continue
        if last == i - 1:
            out[-1][1], out[-1][2] = m.end(), max(out[-1][2], float(p[i]))
        else:
            out.append([m.start(), m.end(), float(p[i])])
        last = i
    chars = lambda b: len(raw[:b].decode("utf-8", "surrogatepass"))
    return [{"from": chars(a), "to": chars(b), "probability": q} for a, b, q in out]


def score(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted, spans (from, to, probability).

    The score is the probability that some token is toxic, from the forward sums over the whole
    text, put on the scale of the labelled documents; spans are runs of tokens whose marginal
    by forward and backward sums is at least 1/2, given for documents predicted toxic. Only
    the text is an input. Null, empty and wordless texts have the lowest score. Repeated rows and null
    ids keep their rows; an empty table gives none; other columns are not read.
    """
    shared = sent(docs.sparkSession, model)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"), held_out(id_col).alias("held_out"))

    def run(batches):
        model = received(shared)
        emit = Emissions(model)
        for batch in batches:
            for part in kn.pieces(batch, "text", 16 << 20):
                texts = part.column("text").to_pylist()
                e = [emit.of(kn.plain_words(t)) for t in texts]
                p = model.probability(model.log_odds(e))
                found = [[] for _ in texts]
                toxic = np.flatnonzero(p >= 0.5).tolist()
                for i, q in zip(toxic, model.token_probabilities([e[i] for i in toxic])):
                    found[i] = spans(texts[i], q)
                yield pa.record_batch({"doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "score": pa.array(p),
                                       "predicted": pa.array((p >= 0.5).astype(np.int32)),
                                       "spans": pa.array(found, pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64()), ("probability", pa.float64())])))})

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int, spans array<struct<from:long,to:long,probability:double>>")
