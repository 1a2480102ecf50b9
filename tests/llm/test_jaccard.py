"""Similar sets against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ridgeline.llm import jaccard as jc
from tests.llm.test_dedup import brute_components, edited

SCHEMA = "doc_id long, text string"


def found(df, **options):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in jc.similar_sets(df, **options).collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@settings(max_examples=400, deadline=None)
@given(st.integers(1, 700), st.sampled_from([50, 80, 90, 100]), st.integers(0, 10 ** 6), st.booleans())
def test_linked_sets_meet(size, percent, seed, crowded):
    """Two sets at the limit share a key, also where their n-grams leave many fragments empty."""
    rng = np.random.default_rng(seed)
    top = 1 << 62 if crowded else 1 << 64  # only a quarter of the fragments
    made = np.unique(rng.integers(0, top, 2 * size + 2, dtype=np.uint64) if top < 1 << 64 else rng.integers(0, 1 << 64, 2 * size + 2, dtype=np.uint64))
    rng.shuffle(made)
    x = made[:size]
    other = int(rng.integers(size, size * 100 // percent + 1))
    drop = 0
    while drop < size and jc.enough(size - drop - 1, size, other, percent) and len(made) >= size + other - (size - drop - 1):
        drop += 1
    y = np.r_[x[drop:], made[size:size + other - (size - drop)]]
    x, y = np.sort(x), np.sort(y)
    both = len(np.intersect1d(x, y))
    if not jc.enough(both, len(x), len(y), percent):
        return
    assert jc.linked(x, y, percent) and jc.shared_count(x, y) == both
    a, b = jc.sketch(x)[None], jc.sketch(y)[None]
    words = min(a.shape[1], b.shape[1])
    apart = int(np.bitwise_count(jc.folded(a, words) ^ jc.folded(b, words)).sum())
    assert apart <= len(x) + len(y) - 2 * both <= jc.most_apart(len(x), len(y), percent)
    if both < max(len(x), len(y)):  # equal sets are one node
        known = jc.Cuts(percent)
        assert set(jc.fragment_keys(x, known).tolist()) & set(jc.fragment_keys(y, known).tolist())


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 400), st.integers(1, 400), st.floats(0, 1), st.integers(0, 10 ** 6))
def test_linked_is_exact(n, m, share, seed):
    rng = np.random.default_rng(seed)
    x = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
    y = np.unique(np.r_[rng.permutation(x)[:int(share * n)], rng.integers(0, 1 << 64, m, dtype=np.uint64)])
    both = len(np.intersect1d(x, y))
    for percent in (50, 90):
        assert jc.linked(x, y, percent) == bool(jc.enough(both, len(x), len(y), percent))


def test_many_empty_fragments(spark):
    """Short texts, of which linked ones may share empty fragments only."""
    rng = random.Random(1)
    rows = []
    for i in range(500):
        w = [f"{i // 5}x{j}" for j in range(rng.randint(9, 24))] if i % 5 == 0 else rows[-1][1].split()
        if i % 5:
            w = w + [f"n{i}"] if rng.random() < .6 else w[:-1]
        rows.append((i, " ".join(w)))
    assert found(frame(spark, rows)) == brute_components(rows, 3, 90)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert found(odd_docs) == brute_components(rows, 3, 90)
    assert found(odd_docs, k=5, percent=60) == brute_components(rows, 5, 60)
    assert jc.similar_sets(no_docs).count() == 0
    with pytest.raises(ValueError):
        jc.similar_sets(no_docs, percent=10)


@pytest.mark.parametrize("rows_in_a_block", [8, 1024])
def test_families(spark, monkeypatch, rows_in_a_block):
    """Wide families of near copies whose members are often not similar to each other, copies, and chains; small blocks and large."""
    monkeypatch.setattr(jc, "BLOCK_ROWS", rows_in_a_block)
    texts = edited(220, 150, 6, 1) + edited(60, 40, 2, 2) + edited(60, 700, 30, 3) + ["a b c d e f"] * 50
    chain = [f"c{i}" for i in range(300)]
    texts += [" ".join(chain[:200 + 5 * i]) for i in range(20)]
    rows = list(enumerate(texts))
    assert found(frame(spark, rows)) == brute_components(rows, 3, 90)


def test_shared_passages(spark):
    """Texts that share most of their words, but not enough."""
    passage = " ".join(f"p{i}" for i in range(160))
    rows = [(i, " ".join([passage, *(f"o{i // 2 if i % 10 == 0 else i}x{j}" for j in range(40))])) for i in range(300)]
    rows += [(1000 + i, rows[i][1] + " end") for i in range(0, 300, 7)]
    assert found(frame(spark, rows)) == brute_components(rows, 3, 90)


def test_rows_of_open_blocks_grow_with_the_texts(spark):
    """Boilerplate of 60 percent: what the stars leave open does not grow with the square of the texts."""
    def opened(n):
        passage = [f"p{i}" for i in range(120)]
        rows = frame(spark, [(i, " ".join([*passage, *(f"o{i}x{j}" for j in range(80))])) for i in range(n)])
        profiles = jc._profiles(rows.withColumn("row_key", rows.doc_id), 3, 90)
        members = profiles.selectExpr("doc_id AS node", "n", "explode(keys) AS key")
        kept = members.join(members.groupBy("key").count().filter("count > 1"), "key").drop("count")
        none = spark.createDataFrame([], "node long, root long")
        return jc._open_units(kept, none).count()

    few, many = opened(400), opened(3200)
    assert few and many <= 8.5 * few
