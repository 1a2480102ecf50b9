"""Spelling variants against loops over all pairs of words."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ridgeline.llm import spelling as sp


def lower(x):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in x)


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def brute(rows, least_length=7, least_count=2, times=10):
    n = Counter()
    for doc_id, text in rows:
        for run in map(lower, re.findall("[A-Za-zÀ-ÿ]+", text or "")):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            run = run if h % 31 else run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += len(run) >= least_length
    n = {w: k for w, k in n.items() if k >= least_count}
    forms, out = {}, {}
    for w in n:
        others = sorted((-n[o], o) for o in n if near(w, o))
        forms[w] = (others[0][1] if others and -others[0][0] >= times * n[w] else None, len(others))
    for w in n:
        root = w
        while forms[root][0]:
            root = forms[root][0]
        out[w] = (forms[w][0], root, n[w], forms[w][1], n.get(forms[w][0]))
    return out


def found(df, **given):
    got = sp.variants(df, **given).collect()
    assert len(got) == len({r.word for r in got})
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}


@pytest.fixture(scope="module")
def crafted(spark):
    """A family of variants with chains, ties, doubled letters, one word of most rows, a very long run and odd characters."""
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abé×ÿ"), rng.integers(6, 10))) for _ in range(150)]
    rows, i = [], 0
    for k, w in enumerate(words):
        for _ in range(int(rng.integers(1, 4)) * (30 if k % 9 == 0 else 1)):
            rows.append((i, f"{w} {w.upper()}1{w}, Ā{w}"))
            i += 1
    rows += [(i + j, "committee " * 40) for j in range(60)] + [(i + 100, "comittee comittee"), (i + 101, "commmittee commmittee"), (i + 102, "committe\ncommitte")]
    rows += [(None, "committee accommodate accommodate"), (i + 103, None), (i + 104, ""), (i + 105, "😀 ... 123"), (1, rows[1][1]), (1, rows[1][1])]
    rows += [(i + 200 + j, f"{'kilogram ' * 30}{'kilograms ' * 2}{'kilogramms' if j < 4 else ''}") for j in range(40)]
    rows += [(i + 106 + j, "x" * 3000 + ("y" if j > 1 else "")) for j in range(5)]
    return rows, spark.createDataFrame([(a, b, "w", 1, "f", 2) for a, b in rows], "doc_id long, text string, word string, n long, form string, length int").repartition(4)


@pytest.mark.parametrize("most_bytes", [sp.MOST_BYTES, 128, 64])
def test_against_pairs(crafted, most_bytes):
    """One pass, and so small filters that lengths are cut into pieces."""
    rows, df = crafted
    want = brute(rows)
    assert max(v[3] for v in want.values()) > 3 and any(v[0] != v[1] for v in want.values() if v[0])
    assert found(df, most_bytes=most_bytes) == want


def test_other_limits(crafted):
    rows, df = crafted
    assert found(df, least_length=2, least_count=1, times=2) == brute(rows, 2, 1, 2)
    with pytest.raises(ValueError):
        sp.variants(df, times=1)


def test_none(spark, no_docs, odd_docs):
    assert sp.variants(no_docs).count() == 0
    assert found(odd_docs) == brute([(r.doc_id, r.text) for r in odd_docs.collect()])


def test_passes():
    """Every word's filter is in one pass, and no pass is larger than allowed."""
    plans = sp.passes({7: 1000, 8: 10, 9: 100_000}, 64 * 100)
    assert all(sum(x[4] for x in p) <= 100 and [x[3] for x in p] == list(np.cumsum([0] + [x[4] for x in p[:-1]])) for p in plans)
    pieces = Counter((x[0], x[2]) for p in plans for x in p)
    assert all(n == total for (_, total), n in pieces.items()) and {k for k, _ in pieces} == {7, 8, 9}
    assert sp.passes({}, 64) == []


def test_filter_has_few_false_positives():
    rng = np.random.default_rng(0)
    inside, outside = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64), rng.integers(0, 1 << 63, 200_000, dtype=np.uint64)
    blocks = -(-len(inside) * sp.BITS // 512)
    table = np.zeros(blocks * sp.BLOCK_WORDS, np.uint64)
    at, bits = sp.bits_of(inside, blocks)
    table[at] = bits
    assert len(sp.let_through(table, 0, blocks, inside)) == len(inside)
    assert len(sp.let_through(table, 0, blocks, outside)) < 0.005 * len(outside)
