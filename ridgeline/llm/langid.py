"""Language identification by fusing text, markup, address and host evidence."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm import kernels as kn
from ridgeline.llm.common import received, sent, text_or_empty
from ridgeline.session import settle

BUCKETS = 1 << 16
#: A text weighs as much as this many independent letter groups at most; all of it is averaged.
EVIDENCE = 200
#: Pseudo-counts: of a language in a group's prior, taken from the level above, and of a declared code.
PRIOR_WEIGHT, CODE_WEIGHT = 4.0, 0.5
MOST_LANGUAGES = 500
#: A language's spread is at least that of independent letters, whose groups of three overlap.
LEAST_SPREAD = 2.0
#: A text that lies this many spreads below its language's usual text is in no known language. Documents in two of the
#: languages reach 15.6 in a sample of 6,465 of the check tool's; random letters 17 and more from 40 letters on.
MOST_BELOW = 16.0
UNKNOWN = "und"
EVEN = -np.log(BUCKETS)

_LETTERS = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def letter_groups(text: str | None) -> np.ndarray:
    """Hash buckets of all groups of three bytes; lower case, other than letters as one space."""
    if not text:
        return np.zeros(0, np.int64)
    words = text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()
    if not words:
        return np.zeros(0, np.int64)
    b = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint64)
    group = (b[:-2] << np.uint64(16)) | (b[1:-1] << np.uint64(8)) | b[2:]
    return ((group * kn.ODD) >> np.uint64(48)).astype(np.int64)


class Model:
    """Log probability of each letter group in each language, and what a language's own texts usually score.

    ``centre`` is the median over a language's labelled texts of the mean log likelihood per letter group,
    ``spread`` how far single texts lie from it, times the root of their groups; see ``usual``.
    """

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.centre, self.spread = np.full(len(languages), EVEN), np.full(len(languages), np.inf)
        total = counts.sum(axis=1, keepdims=True)
        self.log = np.log((counts + 0.5) / (total + 0.5 * BUCKETS)).T.astype(np.float32).copy()

    def scores(self, text: str | None) -> tuple[np.ndarray, int]:
        """Tempered log likelihood of the whole text in each language, and its number of groups."""
        at = letter_groups(text)
        if not len(at):
            return np.zeros(len(self.languages)), 0
        total = np.zeros(len(self.languages))
        for i in range(0, len(at), 1 << 16):
            total += self.log[at[i:i + (1 << 16)]].sum(axis=0, dtype=np.float64)
        return total * (min(len(at), EVIDENCE) / len(at)), len(at)

    def below(self, logs: np.ndarray, groups: int, language: int) -> float:
        """Spreads by which a text's mean log likelihood lies below the usual one; 0 or less at or above it.

        Infinite without letters, and less than a quarter of the way from even chances of all groups to the usual
        text: a language with next to no labelled text is nearly even and would take any noise.
        """
        n = min(groups, EVIDENCE)
        if not n:
            return float("inf")
        gain, usual_gain = logs[language] / n - EVEN, self.centre[language] - EVEN
        if usual_gain > 0 and gain < usual_gain / 4:
            return float("inf")
        return float((self.centre[language] - logs[language] / n) * np.sqrt(n) / self.spread[language])


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Count letter groups per language over all labelled rows, then see what the rows score in their own language.

    Tasks add up their own rows and Spark adds up the tasks; the driver gets 65,536
    counts per language. Rows with a null language, and null or empty texts, teach nothing. More than
    ``MOST_LANGUAGES`` languages raise.
    """
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang IS NOT NULL")

    def run(batches):
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                count = seen.setdefault(lang.as_py(), np.zeros(BUCKETS, np.int64))
                at = letter_groups(text.as_py())
                if len(at):
                    count += np.bincount(at, minlength=BUCKETS)
        for lang, count in seen.items():
            at = np.flatnonzero(count)
            yield pa.record_batch({"lang": pa.array([lang] * len(at), pa.string()), "bucket": pa.array(at), "n": pa.array(count[at])})

    found = settle(rows.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    languages = sorted(r.lang for r in found.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts = np.zeros((len(languages), BUCKETS), np.int64)
    place = {x: i for i, x in enumerate(languages)}
    for r in found.toLocalIterator():
        counts[place[r.lang], r.bucket] = r.n
    return usual(rows, Model(languages, counts))


def usual(labelled: DataFrame, model: Model) -> Model:
    """Set the model's ``centre`` and ``spread`` from all rows (``lang``, ``text``) that have letters.

    The mean over letter groups of a longer text varies less, so distances from the median are taken times the
    root of the number of groups, up to ``EVIDENCE``. The spread is that of the lower quartile of those distances,
    as of a normal curve, so that up to a quarter of wrongly labelled rows does not widen it. Medians and quartiles are
    grouped aggregates of mergeable sketches (exact up to some 10,000 rows of a language).
    """
    if not model.languages:
        return model
    shared = sent(labelled.sparkSession, model)
    place = {x: i for i, x in enumerate(model.languages)}

    def run(batches):
        model = received(shared)
        for batch in batches:
            found = []
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                logs, n = model.scores(text.as_py())
                if n:  # a language whose texts have no letters is not in the model
                    k, n = place[lang.as_py()], min(n, EVIDENCE)
                    found.append((k, logs[k] / n, n))
            yield pa.record_batch([pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.int32(), pa.float64(), pa.int64()))],
                                  names=["k", "score", "n"])

    scored = settle(labelled.mapInArrow(run, "k int, score double, n long"))
    for r in scored.groupBy("k").agg(F.percentile_approx("score", 0.5, 10_000).alias("c")).collect():
        model.centre[r.k] = r.c
    off = (F.col("score") - F.array(*[F.lit(float(c)) for c in model.centre])[F.col("k")]) * F.sqrt("n")
    for r in scored.groupBy("k").agg(F.percentile_approx(off, 0.25, 10_000).alias("q")).collect():
        model.spread[r.k] = max(-r.q / 0.6745, LEAST_SPREAD)
    return model


def _texts(df: DataFrame, model: Model) -> DataFrame:
    """Replace ``text`` by ``ll`` (log likelihoods), ``p`` (what the text alone makes of them) and ``groups``."""
    shared = sent(df.sparkSession, model)
    rest = [c for c in df.columns if c != "text"]

    def run(batches):
        model = received(shared)
        for batch in batches:
            ll, p, groups = [], [], []
            for x in batch.column("text"):
                logs, n = model.scores(x.as_py())
                ll.append(logs)
                # A text without letters says nothing, so it adds nothing to any count.
                p.append(normal(logs) * (n > 0))
                groups.append(n)
            yield pa.record_batch([*(batch.column(c) for c in rest), pa.array(ll, pa.list_(pa.float64())),
                                   pa.array(p, pa.list_(pa.float64())), pa.array(groups, pa.int64())], names=[*rest, "ll", "p", "groups"])

    kinds = dict(df.dtypes)
    return df.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in rest) + ", ll array<double>, p array<double>, groups long")


def normal(logs: np.ndarray) -> np.ndarray:
    e = np.exp(logs - logs.max())
    return e / e.sum()


def fused(ll: np.ndarray, own: np.ndarray, whole: np.ndarray, levels: list, codes: list, code_totals: list) -> np.ndarray:
    """Posterior of one row: likelihood of the text and of its codes, times the prior of its narrowest group.

    All counts are taken without the row's own share.
    """
    n = len(ll)
    rest = np.maximum(whole - own, 0)
    prior = (rest + 1) / (rest.sum() + n)
    for count in levels:
        if count is not None:
            here = np.maximum(np.asarray(count) - own, 0)
            prior = (here + PRIOR_WEIGHT * prior) / (here.sum() + PRIOR_WEIGHT)
    logs = ll + np.log(prior)
    for count, (total, kinds) in zip(codes, code_totals):
        if count is not None:
            with_code = np.maximum(np.asarray(count) - own, 0)
            logs = logs + np.log((with_code + CODE_WEIGHT) / (np.maximum(total - own, 0) + CODE_WEIGHT * kinds))
    return normal(logs)


def identify(df: DataFrame, model: Model, id_col: str, text_col: str, codes: list[str] = (), levels: list[str] = ()) -> DataFrame:
    """One row per row of ``df``: id, lang, probability, text_lang, text_probability, groups, below.

    Probabilities compare the model's languages with each other only. ``below`` is absolute: the spreads by which the
    text lies below the usual text in ``text_lang`` (``Model.below``); above ``MOST_BELOW`` it is in none of the languages.

    ``codes`` are columns that declare a language (markup, address); how far a code can be
    believed is learned by counting it with the languages that the texts alone suggest.
    ``levels`` are columns of nested groups, widest first (address suffix, domain, host): the
    prior of a group is its own count of languages, smoothed by the prior of the level above,
    up to the whole table. A row's own share is taken out of all counts before it is judged.
    Counts come from grouped, partially aggregated sums; a host with most rows is one key of
    a skewed join, not a group in a task.

    Null or empty text gives flat likelihoods, so codes and priors decide; with neither text nor a
    code, the language is ``und`` with probability 0. A null or unknown code is no evidence; a null
    group falls back on the level above. Ties go to the first language by name. Repeated rows
    and null ids keep their rows. Without any labelled text all rows are ``und``. An empty
    table gives no rows.
    """
    langs = model.languages
    base = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                     *[F.lower(F.col(c)).alias(f"c{i}") for i, c in enumerate(codes)],
                     *[F.col(c).cast("string").alias(f"g{i}") for i, c in enumerate(levels)])
    if not langs:
        return base.select(F.col("id").alias(id_col), F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("probability"),
                           F.lit(UNKNOWN).alias("text_lang"), F.lit(0.0).alias("text_probability"), F.lit(0).cast("long").alias("groups"),
                           F.lit(float("inf")).alias("below"))
    rows = settle(_texts(base, model))
    array_sum = F.array(*[F.sum(F.col("p")[i]) for i in range(len(langs))])
    whole = np.array([x or 0.0 for x in rows.agg(array_sum.alias("n")).first().n])
    t, totals = rows, []
    for k in range(len(levels)):
        group = [f"g{j}" for j in range(k + 1)]
        # Stored, so that a group with most rows is a join that Spark can split.
        t = _beside(t, settle(rows.filter(F.col(f"g{k}").isNotNull()).groupBy(*group).agg(array_sum.alias(f"level{k}"))), group, f"level{k}")
    for k in range(len(codes)):
        counts = settle(rows.filter(F.col(f"c{k}").isNotNull()).groupBy(f"c{k}").agg(array_sum.alias(f"code{k}")))
        of_lang = counts.agg(F.array(*[F.sum(F.col(f"code{k}")[i]) for i in range(len(langs))]).alias("n"), F.count(F.lit(1)).alias("kinds")).first()
        totals.append((np.array([x or 0.0 for x in of_lang.n]), max(of_lang.kinds, 1)))
        t = _beside(t, counts, [f"c{k}"], f"code{k}")

    usual_only = Model.__new__(Model)
    usual_only.centre, usual_only.spread = model.centre, model.spread

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                said = any(r[f"c{k}"] in langs for k in range(len(codes)))
                post = fused(np.array(r["ll"]), np.array(r["p"]), whole, [r[f"level{k}"] for k in range(len(levels))],
                             [r[f"code{k}"] for k in range(len(codes))], totals)
                alone, seen = np.array(r["p"]), r["groups"] > 0
                out.append((langs[int(post.argmax())] if seen or said else UNKNOWN, float(post.max()) if seen or said else 0.0,
                            langs[int(alone.argmax())] if seen else UNKNOWN, float(alone.max()) if seen else 0.0,
                            usual_only.below(np.array(r["ll"]), r["groups"], int(alone.argmax()))))
            made = [pa.array([o[i] for o in out], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.string(), pa.float64(), pa.float64()))]
            yield pa.record_batch([batch.column("id"), *made[:4], batch.column("groups"), made[4]],
                                  names=[id_col, "lang", "probability", "text_lang", "text_probability", "groups", "below"])

    kind = dict(rows.dtypes)["id"]
    return t.mapInArrow(run, f"`{id_col}` {kind}, lang string, probability double, text_lang string, text_probability double, groups long, below double")


def _beside(t: DataFrame, counts: DataFrame, keys: list[str], name: str) -> DataFrame:
    a, b = t.alias("_a"), counts.alias("_t")
    match = F.lit(True)
    for k in keys:
        match = match & (F.col(f"_a.{k}") == F.col(f"_t.{k}") if k == keys[-1] else F.col(f"_a.{k}").eqNullSafe(F.col(f"_t.{k}")))
    return a.join(b, match, "left").select("_a.*", f"_t.{name}")


def page_evidence(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, text, markup (declared language), path (language code that starts the path), suffix, domain, host.

    Null and empty pages have an empty text, and null or malformed addresses no path, suffix, domain or host: no evidence. Pages are
    read whole, however long. Repeated rows keep their rows; an empty table gives none; other columns are not read.
    """
    html, url = text_or_empty(html_col), text_or_empty(url_col)
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    text = F.regexp_replace(text, r"&#?\w{1,10};", " ")
    pick = lambda c, pattern: F.nullif(F.lower(F.regexp_extract(c, pattern, 1)), F.lit(""))
    host = pick(url, r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")
    rows = pages.select(F.col(id_col).alias("page_id"), text.alias("text"),
                        pick(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b").alias("markup"),
                        pick(url, r"^[A-Za-z][\w+.-]*://[^/?#]*/([A-Za-z]{2})(?:[/?#]|$)").alias("path"), host.alias("host"))
    return rows.withColumn("suffix", F.substring_index("host", ".", -1)).withColumn("domain", F.substring_index("host", ".", -2))


def identify_pages(pages: DataFrame, model: Model, **columns: str) -> DataFrame:
    """``identify`` on ``page_evidence``, by whose rules and those of ``identify`` odd rows are judged: one row per page."""
    evidence = page_evidence(pages, **columns)
    return identify(evidence, model, "page_id", "text", ["markup", "path"], ["suffix", "domain", "host"])


def in_known_language(docs: DataFrame, least: float = 0.5, most_below: float = MOST_BELOW, id_col: str = "doc_id", text_col: str = "text",
                      lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``docs`` without the rows whose language cannot be told: no letters, no language at ``least`` probability,
    or a text more than ``most_below`` spreads below the usual one of the language it fits best (noise, other languages).

    The model learns from the table's own language labels; the source takes the place of the
    host. Rows keep their columns, whatever their names; equal rows are judged alike.
    """
    model = train(docs, text_col, lang_col)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    both = (text_or_empty(text_col), F.coalesce(F.col(source_col).cast("string"), F.lit("")))
    # Two 64-bit hashes: one alone would let a rejected text take another with it among many billions.
    key = F.concat_ws(":", F.xxhash64(*both), F.xxhash64(F.lit("second"), *both)).alias("_key")
    flat = docs.select(key, F.col(text_col).alias("_text"), F.col(source_col).alias("_source"))
    found = identify(flat, model, "_key", "_text", [], ["_source"])
    reject = found.filter((F.col("lang") == UNKNOWN) | (F.col("probability") < least) | (F.col("below") > most_below)).select("_key").distinct()
    keyed = docs.select(row.alias("row"), key)
    return keyed.join(reject, "_key", "left_anti").select("row.*")
