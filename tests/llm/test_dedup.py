import hashlib
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from ridgeline.llm import components as cc
from ridgeline.llm import exact_dedup as ed
from ridgeline.llm import near_dedup as nd
from ridgeline.session import settle


def stored(df, tmp_path, name="docs", parts=3):
    path = str(tmp_path / name)
    df.repartition(parts).write.parquet(path)
    return path


def exact_expected(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    return Counter((i, min([x for x in g if x is not None], default=None), len(g), hashlib.sha256(t.encode()).digest())
                   for t, g in groups.items() for i in g), len(groups)


def test_exact_groups(spark, odd_docs, tmp_path):
    path = stored(odd_docs, tmp_path)
    want, kept = exact_expected([(r.doc_id, r.text) for r in odd_docs.collect()])
    got = ed.exact_dedup(spark, path).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, bytes(r.digest)) for r in got) == want
    assert sum(r.kept for r in got) == kept


def test_exact_with_colliding_digests(spark, odd_docs, tmp_path):
    """A digest of one bit puts most texts together; the full bytes tell them apart."""
    path = stored(odd_docs, tmp_path)
    want, kept = exact_expected([(r.doc_id, r.text) for r in odd_docs.collect()])
    got = ed.exact_dedup(spark, path, digest=lambda c: F.unhex(F.when(F.sha2(c, 256) < "8", "00").otherwise("01"))).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == Counter(k[:3] for k in want.elements())
    assert sum(r.kept for r in got) == kept


def test_state_goes_on(spark, tmp_path):
    """New files meet the state of old ones; several small batches give what one gives."""
    path, state = str(tmp_path / "grow"), str(tmp_path / "state")
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    frame([(5, "a b"), (6, "c")]).write.parquet(path)
    assert ed.exact_dedup(spark, path, checkpoint=state).filter("kept").count() == 2
    frame([(1, "a  b"), (7, "d")]).write.mode("append").parquet(path)
    frame([(8, "a b"), (9, "d")]).write.mode("append").parquet(path)
    got = {r.doc_id: (r.keep_id, r.group_size) for r in ed.exact_dedup(spark, path, checkpoint=state, batch_bytes=1).collect()}
    assert got == {5: (1, 3), 1: (1, 3), 8: (1, 3), 6: (6, 1), 7: (7, 2), 9: (7, 2)}


def test_exact_empty(spark, no_docs, tmp_path):
    assert ed.exact_dedup(spark, stored(no_docs, tmp_path, parts=1)).count() == 0


def shingle_sets(rows, k):
    lower = {c: c + 32 for c in range(65, 91)}
    out = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        out.append({tuple(w)} if 0 < len(w) < k else {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set())
    return out


def brute_components(rows, k, percent=80):
    sets = shingle_sets(rows, k)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    for i, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in holders[g] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    name = {i: min([rows[j][0] for j in g if rows[j][0] is not None], default=None) for g in groups.values() for i in g}
    return Counter((rows[i][0], len(sets[i]), name[i] if sets[i] else rows[i][0]) for i in range(len(rows)))


def near_rows(df, **options):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in nd.near_duplicates(df, **options).collect())


def test_near_groups_of_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    for k in (4, 5):
        assert near_rows(odd_docs, k=k) == brute_components(rows, k)


def edited(n, words, edits, seed):
    """Texts that differ from one base in a few places, more and more of them."""
    import random

    rng = random.Random(seed)
    base = [f"b{seed}w{i}" for i in range(words)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            at = rng.randrange(len(w))
            w[at] = f"e{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_near_groups_against_all_pairs(spark):
    """A wide group of near copies, in which many similar pairs are not similar to the smallest node."""
    texts = edited(250, 120, 14, 1) + edited(60, 40, 4, 2) + edited(60, 60, 9, 3)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert near_rows(df, k=4) == brute_components(rows, 4)


def test_blocks_of_a_crowded_bucket(spark, monkeypatch):
    """Blocks far smaller than a bucket find the same links."""
    monkeypatch.setattr(nd, "BLOCK", 16)
    rows = list(enumerate(edited(150, 120, 14, 4)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert near_rows(df, k=4) == brute_components(rows, 4)


def test_without_near_duplicates(spark, odd_docs, no_docs):
    left = nd.without_near_duplicates(odd_docs)
    assert left.columns == odd_docs.columns
    ids = Counter(r.doc_id for r in left.collect())
    # The twelve words stay once; the long texts are one group; texts without words stay.
    assert ids == Counter([1, 4, 5, 6, None, 7, 9, 10, 11, 12])
    assert nd.without_near_duplicates(no_docs).count() == 0 and nd.near_duplicates(no_docs).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(100, i) for i in range(101, 160)]
    edges = spark.createDataFrame(chain + star + [(200, 200), (100, 101), (300, -5)], "u long, v long")
    got = {r.node: r.root for r in cc.components(settle(edges)).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {300: -5, -5: -5}
    assert got == want
    assert cc.components(edges.limit(0)).count() == 0
