"""Vector codes against plain distances."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ridgeline.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, x string, code int, part string"


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 9), st.integers(1, 40), st.integers(1, 60), st.sampled_from([1, 6, 3000, 1 << 24]), st.integers(0, 10 ** 6))
def test_nearest(width, entries, rows, size, seed):
    """Any width, ties, and components at the limit of exact sums."""
    rng = np.random.default_rng(seed)
    size = min(size, codes.largest(width))
    e, x = rng.integers(-size, size + 1, (entries, width)), rng.integers(-size, size + 1, (rows, width))
    at, d = codes.Codebook(e).nearest(x)
    whole = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, s)) for s in e] for r in x]
    assert d.tolist() == [min(w) for w in whole] and at.tolist() == [w.index(min(w)) for w in whole]


def test_sequency():
    h = codes.sequency(16)
    assert (h @ h.T == 16 * np.eye(16)).all()
    assert [int((r[1:] != r[:-1]).sum()) for r in h] == list(range(16))


def plain(rows, parts, entries, rounds):
    """(vec_id, code, error, label_error) and codebooks by loops over whole numbers."""
    import math
    from collections import Counter, defaultdict

    kept = [(i, lab, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = -(-max((len(r[2]) for r in kept), default=0) // parts)
    cut = [[(r[2] + [0] * (parts * width))[p * width:(p + 1) * width] for p in range(parts)] for r in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        d = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        new = []
        for p in range(parts):
            of = defaultdict(list)
            for c in cut:
                of[nearest(c[p], books[p])[0]].append(c[p])
            new.append([[sum(z) // len(of[i]) for z in zip(*of[i])] if i in of else e for i, e in enumerate(books[p])])
        books = new
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    error = Counter()
    for r, f in zip(kept, found):
        error[r[1]] += sum(d for _, d in f)
    return Counter((r[0], "".join(f"{i:02x}" for i, _ in f), sum(d for _, d in f), error[r[1]]) for r, f in zip(kept, found)), books


def result(df, **given):
    coded, books = codes.compress(df, **given)
    from collections import Counter

    return Counter((r.vec_id, r.code, r.error, r.label_error) for r in coded.collect()), [[[int(x) for x in e] for e in b] for b in books]


def test_odd_vectors(spark):
    """Nulls, missing and non-finite components, short, empty and repeated vectors, equal and null ids, clashing columns."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.3, 10).tolist(), int(rng.integers(0, 3))) for i in range(60)]
    rows += [(100, None, 1), (101, [0.1, None], 1), (102, [float("nan")] * 10, 1), (103, [float("inf")] * 10, None), (104, [], None),
             (105, [0.25] * 4, None), (None, [-0.1] * 10, 2), (7, rows[7][1], rows[7][2]), (7, rows[8][1], None), (-5, [0.3] * 10, 0)]
    df = spark.createDataFrame([(i, v, lab, "x", 1, "y") for i, v, lab in rows], SCHEMA).repartition(3)
    for entries in (4, 256):
        assert result(df, entries=entries) == plain(rows, 4, entries, 4)
    assert result(df, parts=3, entries=7, rounds=2) == plain(rows, 3, 7, 2)


def test_none_and_too_large(spark):
    none = spark.createDataFrame([(1, None, 1, "x", 1, "y")], SCHEMA)
    assert result(none)[0] == {} and result(none.limit(0))[0] == {}
    with pytest.raises(ValueError):
        codes.compress(spark.createDataFrame([(1, [1e30] * 8, 1, "x", 1, "y")], SCHEMA))


def test_one_label_and_equal_vectors(spark):
    """A hot label and many equal vectors: one entry takes them all, the others stay."""
    rows = [(i, [0.5, -0.5, 0.1, 0.2] if i % 10 else [i / 100] * 4, 1) for i in range(400)]
    df = spark.createDataFrame([(i, v, lab, "x", 1, "y") for i, v, lab in rows], SCHEMA)
    assert result(df, entries=16) == plain(rows, 4, 16, 4)
