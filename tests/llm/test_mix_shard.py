from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ridgeline.llm import mixing, sharding


def filled(sizes, weights, most=3):
    """Targets by halving the level until it fits: another way to the same numbers."""
    total, low, high = sum(sizes), 0.0, 1e12
    for _ in range(300):
        mid = (low + high) / 2
        if sum(min(most * s, mid * w) for s, w in zip(sizes, weights)) < total:
            low = mid
        else:
            high = mid
    return [min(most * s, high * w) for s, w in zip(sizes, weights)]


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1, 10, 1000], [5, 5, 5, 5, 900, 7], [0, 0, 12], [50]])
def test_targets(spark, sizes):
    weights = [1 + i % 3 for i in range(len(sizes))]
    made = spark.createDataFrame([(f"s{i}", s, w) for i, (s, w) in enumerate(zip(sizes, weights))], "source string, source_size long, weight int")
    got = [r.target for r in mixing.water_fill(made).orderBy("source").collect()]
    assert got == pytest.approx(filled(sizes, weights), rel=1e-9, abs=1e-6)


def test_mixture_meets_targets(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 37)), f"s{i % 3 if i % 2 else 0}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    report = mixing.mix_report(df).collect()
    taken, target = Counter(), {}
    for r in report:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r.size
    for s in target:
        assert abs(taken[s] - target[s]) <= 37
    assert sorted(report) == sorted(mixing.mix_report(df.repartition(3)).collect())
    mixed = Counter(r.doc_id for r in mixing.mix(df).collect())
    assert mixed == Counter({r.doc_id: r.repeats for r in report if r.repeats})


def test_odd_mixture(spark, odd_docs, no_docs):
    report = mixing.mix_report(odd_docs).collect()
    assert len(report) == odd_docs.count()
    weights = {r.source: r.target for r in report}
    assert set(weights) == {"a", "b", "c", "", None}
    assert mixing.mix(odd_docs).columns == odd_docs.columns
    assert mixing.mix(no_docs).count() == 0 and mixing.mix_report(no_docs).count() == 0
    own = spark.createDataFrame([("a", 1), ("c", 0)], "name string, share int")
    assert {r.source: r.target > 0 for r in mixing.mix_report(odd_docs, weights=own).collect()}["c"] is False


def test_shards_hold_the_mixture(spark):
    rows = [(i, f"s{0 if i % 3 else i % 5}") for i in range(4001)]
    df = spark.createDataFrame(rows, "doc_id long, source string").repartition(6)
    got = sharding.shard(df, 8).collect()
    slots, mix = defaultdict(list), defaultdict(Counter)
    for r in got:
        slots[r.shard].append(r.slot)
        mix[r.shard][r.source] += 1
    sizes = [len(v) for v in slots.values()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    whole = Counter(s for _, s in rows)
    for m in mix.values():
        assert all(abs(m[s] - whole[s] / 8) <= 2 for s in whole)
    assert sorted(got) == sorted(sharding.shard(df.repartition(2), 8).collect())


def test_odd_shards(spark, odd_docs, no_docs):
    got = sharding.shard(odd_docs.withColumn("shard", F.lit("x")), 5).collect()
    assert len(got) == odd_docs.count() and Counter(r.shard for r in got) == Counter({0: 4, 1: 3, 2: 3, 3: 3, 4: 3})
    assert sharding.shard(odd_docs.limit(2), 5).select("shard").distinct().count() == 2
    assert sharding.shard(no_docs, 5).count() == 0


def by_hand(rows, shards, seed="shard-1"):
    """{(id, source): [(shard, slot)]} from sorted lists."""
    import hashlib

    order = lambda i: hashlib.md5(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    of_source = defaultdict(list)
    for i, s in rows:
        of_source[s].append((order(i), i is not None, i or 0, i))
    placed = []
    for s, found in of_source.items():
        for k, (o, *_, i) in enumerate(sorted(found)):
            placed.append(((2 * k + 1) / (2 * len(found)), s is None, s or "", o, i, s))
    placed.sort(key=lambda r: r[:4])
    out, seen = defaultdict(list), Counter()
    for at, (*_, i, s) in enumerate(placed):
        shard = at * shards // len(placed)
        out[i, s].append((shard, seen[shard]))
        seen[shard] += 1
    return out


@pytest.mark.parametrize("shards", [1, 7, 8])
def test_shards_by_hand(spark, shards):
    rows = [(i, f"s{0 if i % 3 else i % 7}" if i % 11 else None) for i in range(500)] + [(None, "s0"), (3, "s0"), (3, "s0")]
    df = spark.createDataFrame([(*r, "t", 5) for r in rows], "doc_id long, source string, text string, shard int").repartition(4)
    got = defaultdict(list)
    for r in sharding.shard(df, shards).collect():
        got[r.doc_id, r.source].append((r.shard, r.slot))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in by_hand(rows, shards).items()}


def test_query_of_shards(spark):
    """Sizes, checksums and places of the registered query, worked out by hand."""
    import zlib

    from ridgeline.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source", "text").collect()
    at = by_hand([(r.doc_id, r.source) for r in docs], 8)
    got = {r.doc_id: r for r in QUERIES["op8_sharding"](spark, folder).collect()}
    assert len(got) == len(docs)
    for r in docs:
        data, found = (r.text or "").encode(), got[r.doc_id]
        assert (found.size, found.text_crc32, found.law, found.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
        assert [(found.shard, found.slot)] == at[r.doc_id, r.source]
