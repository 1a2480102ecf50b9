import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgeline.llm import katz, langid, toxicity
from ridgeline.llm.common import table

SF = "/root/testdata/sf0.01"


# Language model

def learns(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 != 0


class Plain:
    """The same model by dictionaries."""

    def __init__(self, docs, order=2):
        self.order = order
        # By order: how often words follow a history (a tuple, the last word last), and how often it occurs.
        self.n_grams = [defaultdict(Counter) for _ in range(order)]
        for i, text in docs:
            if learns(i):
                s = ["<s>"] * (order - 1) + self.tokens(text)
                for at in range(order - 1, len(s)):
                    for k in range(order):
                        self.n_grams[k][tuple(s[at - k:at])][s[at]] += 1
        self.after = [{h: sum(c.values()) for h, c in level.items()} for level in self.n_grams]
        of = lambda values: katz.discounts([sum(v == r for v in values) for r in range(1, 7)])
        self.d = [of([c for h in level.values() for c in h.values()]) for level in self.n_grams]
        self.uni = self.n_grams[0][()]
        self.n = sum(self.uni.values())
        self.unknown = 1 - sum(self.cut(c, self.d[0]) for c in self.uni.values()) / self.n if self.n else 1.0
        self.weights = {}

    @staticmethod
    def tokens(text):
        return [*(text or "").encode().lower().split(), "</s>"]

    @staticmethod
    def cut(c, d):
        return c * d[c - 1] if c <= 5 else c - katz.GIVEN

    def weight(self, h):
        if h not in self.weights:
            seen = self.n_grams[len(h)].get(h)
            self.weights[h] = 1.0 if not seen else (1 - sum(self.cut(c, self.d[len(h)]) for c in seen.values()) / self.after[len(h)][h]) / (
                1 - sum(self.p(h[1:], w) for w in seen))
        return self.weights[h]

    def p(self, h, w):
        seen = self.n_grams[len(h)].get(h, ())
        if w in seen:
            return self.cut(seen[w], self.d[len(h)]) / self.after[len(h)][h]
        return self.weight(h) * self.p(h[1:], w) if h else self.unknown

    def row(self, i, text):
        t = self.tokens(text)
        base = sum(math.log10((self.uni[w] + 0.1) / (self.n + 0.1 * (len(self.uni) + 1))) for w in t)
        s = ["<s>"] * (self.order - 1) + t
        score = sum(math.log10(self.p(tuple(s[j:j + self.order - 1]), w)) for j, w in enumerate(t))
        return (i, not learns(i), len(t), sum(w in self.uni for w in t), self.n, base, score)


def same_scores(found, docs, order=2):
    model = Plain(docs, order)
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found.collect()), key=key)
    want = sorted((model.row(*d) for d in docs), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5:] for g in got] == [pytest.approx(w[5:], rel=1e-8, abs=1e-7) for w in want]
    return model


@pytest.mark.parametrize("options", [{}, {"bucket_bytes": 20_000, "hot": 200}, {"order": 3}, {"order": 3, "bucket_bytes": 20_000, "hot": 30},
                                     {"order": 4, "bucket_bytes": 100_000, "hot": 100}])
def test_scores_against_dictionaries(spark, options, monkeypatch):
    """Orders two to four; words after a history sum to one, seen ones and all others."""
    monkeypatch.setattr(katz, "PART_TOKENS", 20_000)
    df = table(spark, SF, "documents").select("doc_id", "text").repartition(3)
    docs = [(r.doc_id, r.text) for r in df.collect()]
    order = options.get("order", 2)
    model = same_scores(katz.score(df, **options), docs, order)
    seen = docs[3][1].encode().lower().split()[:5]
    for h in [("<s>",), (b"the",), (b"der",), *((w,) for w in seen), *(tuple(seen[i:i + order - 1]) for i in range(3)), ("<s>",) * (order - 1)]:
        assert sum(model.p(h, w) for w in model.uni) + model.p(h, "unknown") == pytest.approx(1, abs=1e-9)


def test_longer_histories_tell_more_of_seen_texts(spark):
    docs = table(spark, SF, "documents").limit(300)
    seen = [katz.score(docs, order=k).filter("NOT held_out").agg(F.sum("score")).first()[0] for k in (2, 3)]
    assert seen[1] > 0.7 * seen[0]
    with pytest.raises(ValueError):
        katz.score(docs, order=1)


def test_model_beats_base_on_held_out(spark):
    a, b = katz.score(table(spark, SF, "documents"), stored=True).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert a > 0.75 * b


def test_odd_scores(spark, odd_docs, no_docs):
    for order in (2, 3):
        same_scores(katz.score(odd_docs, order=order), [(r.doc_id, r.text) for r in odd_docs.collect()], order)
    assert katz.score(no_docs).count() == 0
    none_learned = odd_docs.filter("doc_id IS NULL")
    assert {r.score for r in katz.score(none_learned.filter("text IS NULL")).collect()} == {0.0}


def test_discounts():
    d = katz.discounts([1000, 400, 220, 150, 110, 90])
    share = 6 * 90 / 1000
    assert d[0] == pytest.approx((2 * 400 / 1000 - share) / (1 - share))
    assert all(0 < x < 1 for x in katz.discounts([0, 0, 0, 0, 0, 0])) and all(0 < x < 1 for x in katz.discounts([5, 9, 1, 0, 3, 3]))


# Language

def test_languages_of_unseen_documents(spark):
    docs = table(spark, SF, "documents")
    model = langid.train(docs.filter("doc_id % 2 = 0"))
    found = langid.identify(docs.filter("doc_id % 2 = 1"), model, "doc_id", "text", [], ["source"])
    right = found.join(docs.select("doc_id", F.col("lang").alias("label")), "doc_id").agg(F.avg((F.col("lang") == F.col("label")).cast("int"))).first()[0]
    assert right > 0.98


def plain_posterior(rows, langs, levels, codes):
    """The fusion by plain loops: rows are (log likelihoods, own, level keys, code keys)."""
    total = lambda test: np.sum([r[1] for r in rows if test(r)], axis=0) if any(test(r) for r in rows) else np.zeros(langs)
    out = []
    for ll, own, groups, said in rows:
        rest = total(lambda r: True) - own
        prior = (rest + 1) / (rest.sum() + langs)
        for k in range(levels):
            if groups[k] is not None:
                n = total(lambda r: r[2][:k + 1] == groups[:k + 1]) - own
                prior = (n + langid.PRIOR_WEIGHT * prior) / (n.sum() + langid.PRIOR_WEIGHT)
        logs = ll + np.log(prior)
        for k in range(codes):
            if said[k] is not None:
                kinds = len({r[3][k] for r in rows if r[3][k] is not None})
                n, every = total(lambda r: r[3][k] == said[k]) - own, total(lambda r: r[3][k] is not None) - own
                logs = logs + np.log((n + langid.CODE_WEIGHT) / (every + langid.CODE_WEIGHT * kinds))
        e = np.exp(logs - logs.max())
        out.append(e / e.sum())
    return out


def test_fusion_against_loops(spark):
    docs = table(spark, SF, "documents")
    model = langid.train(docs)
    texts = [r.text for r in docs.limit(12).collect()] + ["", None, "la"]
    rows = [(i, t, ["fr", "xx", None][i % 3], ["com", "net", None][i % 3], f"h{i % 4}" if i % 5 else None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "page_id long, text string, code string, suffix string, host string")
    got = {r.page_id: r for r in langid.identify(df, model, "page_id", "text", ["code"], ["suffix", "host"]).collect()}
    scored = [model.scores(t) for t in texts]
    want = plain_posterior([(ll, langid.normal(ll) * (n > 0), list(r[3:5]), [r[2]]) for (ll, n), r in zip(scored, rows)], len(model.languages), 2, 1)
    for i, p in enumerate(want):
        if got[i].lang != langid.UNKNOWN:
            assert got[i].probability == pytest.approx(p.max(), rel=1e-9) and got[i].lang == model.languages[int(p.argmax())]
    assert got[13].lang == langid.UNKNOWN


def test_evidence_beside_the_text(spark):
    """With next to no text, what the markup says and what the host's other pages are decides."""
    docs = table(spark, SF, "documents")
    model = langid.train(docs)
    de = [r.text for r in docs.filter("lang = 'de'").limit(8).collect()]
    fr = [r.text for r in docs.filter("lang = 'fr'").limit(8).collect()]
    page = lambda lang, text: f"<html lang='{lang}'><script>the of and</script><p>{text}</p></html>"
    rows = [(i, f"http://a.de.example/{i}", page("de", t)) for i, t in enumerate(de)] + [(20 + i, f"http://b.fr.example/{i}", page("fr", t)) for i, t in enumerate(fr)]
    rows += [(40, "http://a.de.example/x", page("de", "w")), (41, "http://b.fr.example/y", page("fr", "w")), (42, "http://c.example/", page("fr", ""))]
    rows += [(43, None, None), (None, "no address", "<p>12 34</p>")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, host int")
    got = {r.page_id: r for r in langid.identify_pages(df, model).collect()}
    assert got[40].lang == "de" and got[41].lang == "fr" and got[42].lang == "fr"
    assert got[43].lang == got[None].lang == langid.UNKNOWN
    assert langid.identify_pages(df.limit(0), model).count() == 0


def test_very_long_page(spark):
    """A page of some megabytes is read whole: its language is that of its later, longer part."""
    docs = table(spark, SF, "documents")
    model = langid.train(docs)
    parts = {k: " ".join(r.text for r in docs.filter(F.col("lang") == k).limit(60).collect()) for k in ("de", "fr")}
    html = f"<p>{parts['fr']}</p>" + "".join(f"<p>{parts['de']}</p>" for _ in range(25))
    df = spark.createDataFrame([(1, None, html), (2, None, parts["fr"])], "page_id long, url string, html string")
    got = {r.page_id: r for r in langid.identify_pages(df, model).collect()}
    assert len(html) > 1_000_000 and got[1].lang == "de" and got[2].lang == "fr" and got[1].groups > 1_000_000


def test_known_languages_stay(spark, odd_docs, no_docs):
    left = langid.in_known_language(odd_docs)
    gone = odd_docs.exceptAll(left)
    assert left.columns == odd_docs.columns
    assert {r.doc_id for r in gone.collect()} >= {4, 5, 6, 12} and not {1, 2, 3, 7, 8} & {r.doc_id for r in gone.collect()}
    assert langid.in_known_language(no_docs).count() == 0
    assert langid.in_known_language(odd_docs.withColumn("lang", F.lit(None).cast("string"))).count() == 0
    docs = table(spark, SF, "documents")
    assert langid.in_known_language(docs).count() >= 0.99 * docs.count()


# Toxicity

def all_paths(e, step):
    """Marginals and log odds of any toxic token, by listing every path."""
    n = len(e)
    weight = {}
    for x in range(1 << n):
        s = [(x >> t) & 1 for t in range(n)]
        weight[x] = math.exp(sum(e[t] * s[t] for t in range(n)) + sum(step[s[t], s[t + 1]] for t in range(n - 1)))
    z = sum(weight.values())
    return [sum(w for x, w in weight.items() if x >> t & 1) / z for t in range(n)], math.log((z - weight[0]) / weight[0])


def test_sums_over_paths():
    rng = np.random.default_rng(2)
    model = toxicity.Crf()
    model.step = rng.normal(size=(2, 2))
    e = [rng.normal(size=n) * 2 for n in (1, 7, 3, 0, 5)]
    odds, p = model.log_odds(e), model.token_probabilities(e)
    for x, o, q in zip(e, odds, p):
        if len(x):
            want, total = all_paths(x, model.step)
            assert q == pytest.approx(want) and o == pytest.approx(total)
    padded = np.zeros((5, 7))
    valid = np.zeros((5, 7), bool)
    for i, x in enumerate(e):
        padded[i, :len(x)], valid[i, :len(x)] = x, True
    marginals, _ = model.marginals(padded, valid)
    assert marginals[1] == pytest.approx(p[1]) and marginals[4, :5] == pytest.approx(p[4])


def auc(rows):
    good = [s for s, y in rows if y]
    bad = [s for s, y in rows if not y]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


def test_held_out_documents(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    model = toxicity.train(toxicity.sample(docs, labels))
    held = labels.filter(toxicity.held_out("doc_id"))
    few = docs.join(held, "doc_id")
    got = toxicity.score(few, model).join(held, "doc_id").select("score", "toxic", "predicted", "held_out", "spans").collect()
    assert all(r.held_out for r in got) and auc([(r.score, r.toxic) for r in got]) > 0.9
    assert sum(r.predicted == r.toxic for r in got) / len(got) > 0.95
    assert all(bool(r.spans) or not r.predicted for r in got if r.score > 0.9)


def test_spans_name_the_words(spark):
    text = "A ünkind Moron, moron word; über idiots."
    p = np.array([0.1, 0.1, 0.9, 0.8, 0.1, 0.2, 0.7])
    assert [(text[s["from"]:s["to"]], s["probability"]) for s in toxicity.spans(text, p)] == [("Moron, moron", 0.9), ("idiots", 0.7)]


def test_odd_toxicity(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(1, 13)] + [(None, 1, "x"), (3, None, "x"), (5, 7, "x")], "doc_id long, toxic int, text string")
    model = toxicity.train(toxicity.sample(odd_docs, labels))
    got = toxicity.score(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert toxicity.score(no_docs, model).count() == 0
    blank = toxicity.train(toxicity.sample(odd_docs, labels.limit(0)))
    assert len({r.score for r in toxicity.score(odd_docs, blank).collect()}) == 1
