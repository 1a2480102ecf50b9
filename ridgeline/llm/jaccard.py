"""Similar sets of word n-grams: the order of all n-grams is cut into fragments, and pairs add up what they share in each."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm import kernels as kn
from ridgeline.llm import screen
from ridgeline.llm.common import settings
from ridgeline.llm.components import components
from ridgeline.session import settle

#: Sets are compared in fragments of about so many n-grams.
FRAGMENT = 128
#: Of what one task compares at once: rows, and n-grams of all rows together.
BLOCK_ROWS, BLOCK_GRAMS = 1024, 1 << 20
_SPARSE = 0x5BD1E9955BD1E995
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}

# The order of n-grams is that of their 64-bit hashes, so a fragment is a range of hashes, the same in every text.


def most_apart(a: int, b: int, percent: int) -> int:
    """N-grams that are in one of two linked sets only, at most: with i in both, 100 i >= percent (a + b - i)."""
    return (a + b) * (100 - percent) // (100 + percent)


def fragments(n: int, percent: int) -> int:
    """Fragments for pairs whose smaller set has ``n``; 0 if such a set is linked with equal ones only.

    There are more of them than a linked pair can differ in, so a pair has equal fragments; the spare ones make up for
    fragments without any n-gram, which say nothing. Rounded up so that few numbers are in use.
    """
    apart = most_apart(n, n * 100 // percent, percent)
    if not apart:
        return 0
    need = apart + 1 + (1 if n < 100 else 2 + n // 2000)
    step = 1 << max(need.bit_length() - 3, 0)
    return -(-need // step) * step


def fewest_equal(cuts: int, percent: int) -> int:
    """Equal fragments that every linked pair has which is cut into ``cuts``."""
    low, high = 1, 2
    while fragments(high, percent) <= cuts:
        low, high = high, high * 2
    while high - low > 1:  # the largest set that is cut into so many
        middle = (low + high) // 2
        low, high = (middle, high) if fragments(middle, percent) <= cuts else (low, middle)
    return cuts - most_apart(low, low * 100 // percent, percent)


class Cuts(dict):
    """For a number of n-grams: its numbers of fragments, each with the fewest equal ones of a linked pair; remembered."""

    def __init__(self, percent: int):
        super().__init__()
        self.percent = percent

    def __missing__(self, n: int) -> list[tuple[int, int]]:
        if len(self) >= kn.MOST_WORDS_KEPT:
            self.clear()
        value = self[n] = [(c, fewest_equal(c, self.percent)) for c in cuts_of(n, self.percent)]
        return value


def cuts_of(n: int, percent: int) -> tuple[int, ...]:
    """All numbers of fragments that pairs with a set of ``n`` may be cut into: those of smaller sets it can be linked with."""
    least = -(-n * percent // 100)
    out, size = set(), n
    while size >= least:
        cuts = fragments(size, percent)
        if not cuts:
            break
        out.add(cuts)
        low, high = 0, size  # on to the largest size with fewer
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if fragments(middle, percent) < cuts else (low, middle)
        size = low
    return tuple(sorted(out))


def fragment_keys(found: np.ndarray, known: Cuts) -> np.ndarray:
    """A hash of what each fragment with n-grams holds, for every number of cuts; linked sets share one at least.

    If nothing but empty fragments is equal in a pair, both have many of them; all such sets share one more key.
    """
    out = []
    for cuts, fewest in known[len(found)]:
        at = ((found >> np.uint64(32)) * np.uint64(cuts)) >> np.uint64(32)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        held = np.add.reduceat(kn.mixed(found ^ kn.ODD), first)
        out.append(kn.mixed(kn.mixed(at[first] + np.uint64(cuts << 32)) + held))
        if cuts - len(first) >= fewest:
            out.append(kn.mixed(np.array([cuts ^ _SPARSE], np.uint64)))
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def sketch(found: np.ndarray) -> np.ndarray:
    """Parities of the n-grams that fall on each of some 4 to 8 bits per n-gram.

    An n-gram in one of two sets only changes one bit, so two sketches differ in no more bits than the sets in n-grams.
    """
    size = 1 << max((4 * len(found) - 1).bit_length(), 6)
    bits = np.bincount((kn.mixed(found ^ np.uint64(_SPARSE)) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(x: np.ndarray, words: int) -> np.ndarray:
    """Sketches (rows, words) as they would be with fewer words."""
    while x.shape[1] > words:
        half = x.shape[1] // 2
        x = x[:, :half] ^ x[:, half:]
    return x


def grams_of(text: str | None, k: int, hashes: kn.WordHashes) -> np.ndarray:
    """Sorted hashes of the distinct runs of k words; fewer words are one run."""
    words = kn.space_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = hashes.of(words)
    return np.unique(kn.grams(h, min(k, len(h))))


def digest_of(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def pieces_of(n: int) -> int:
    """Fragments in which sets are compared whose smaller one has ``n``."""
    return 1 << max(-(-n // FRAGMENT) - 1, 0).bit_length()


def enough(both, a, b, percent: int):
    return 100 * both >= percent * (a + b - both)


def shared_count(x: np.ndarray, y: np.ndarray) -> int:
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets share enough, fragment by fragment; given up when the rest cannot make up for it."""
    pieces = pieces_of(min(len(x), len(y)))
    shift = np.uint64(65 - pieces.bit_length())
    ends = np.arange(1, pieces, dtype=np.uint64) << shift if pieces > 1 else np.zeros(0, np.uint64)
    i, j = np.r_[0, np.searchsorted(x, ends), len(x)], np.r_[0, np.searchsorted(y, ends), len(y)]
    apart, most = 0, most_apart(len(x), len(y), percent)
    for a, b, c, d in zip(i[:-1].tolist(), i[1:].tolist(), j[:-1].tolist(), j[1:].tolist()):
        apart += (b - a) + (d - c) - 2 * shared_count(x[a:b], y[c:d])
        if apart > most:
            return False
    return True


def _numbers(column: pa.Array, i: int) -> np.ndarray:
    return np.frombuffer(column[i].as_buffer(), np.uint64)


def _profiles(docs: DataFrame, k: int, percent: int) -> DataFrame:
    def run(batches):
        hashes, known = kn.WordHashes(), Cuts(percent)
        for batch in batches:
            for part in kn.pieces(batch, "text"):
                digest, size, keys = [], [], []
                for text in part.column("text").to_pylist():
                    found = grams_of(text, k, hashes)
                    digest.append(digest_of(found))
                    size.append(len(found))
                    keys.append(fragment_keys(found, known))
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"), "row_key": part.column("row_key"), "digest": pa.array(digest, pa.binary()),
                    "n": pa.array(size, pa.int64()), "keys": pa.array(keys, pa.list_(pa.int64()))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, row_key long, digest binary, n long, keys array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(node, n, sketch, items) of the stored ``wanted`` (row_key, digest, node); a bitmap keeps other texts from being cut."""
    bits = screen.bits_for(wanted.count())
    bitmap = screen.bitmap(wanted.select("row_key"), bits)

    def run(batches):
        hashes = kn.WordHashes()
        for batch in batches:
            keys = batch.column("row_key").to_numpy(zero_copy_only=False).astype(np.int64)
            texts = batch.column("text")
            keep = np.flatnonzero(kn.in_bitmap(bitmap.value, bits, keys.view(np.uint64))).tolist()
            for i in range(0, len(keep), 256):
                sets = [grams_of(texts[j].as_py(), k, hashes) for j in keep[i:i + 256]]
                yield pa.record_batch({
                    "row_key": pa.array(keys[keep[i:i + 256]]), "digest": pa.array([digest_of(s) for s in sets], pa.binary()),
                    "n": pa.array([len(s) for s in sets], pa.int64()), "sketch": pa.array([sketch(s).tobytes() for s in sets], pa.binary()),
                    "items": pa.array([s.tobytes() for s in sets], pa.binary())})

    found = docs.select("row_key", "text").mapInArrow(run, "row_key long, digest binary, n long, sketch binary, items binary")
    # Rows repeated with id and text give the same set twice.
    return settle(found.join(wanted, ["row_key", "digest"]).groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "sketch", "items")]))


def _close(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose sizes and sketches allow a link, as (u, v, nu, nv)."""
    one = sets.select(F.col("node").alias("u"), F.col("n").alias("nu"), F.col("sketch").alias("su"))
    two = sets.select(F.col("node").alias("v"), F.col("n").alias("nv"), F.col("sketch").alias("sv"))

    def run(batches):
        for batch in batches:
            nu, nv = (batch.column(c).to_numpy() for c in ("nu", "nv"))
            su, sv, good = batch.column("su"), batch.column("sv"), []
            for i in np.flatnonzero(100 * np.minimum(nu, nv) >= percent * np.maximum(nu, nv)).tolist():
                x, y = _numbers(su, i)[None], _numbers(sv, i)[None]
                words = min(x.shape[1], y.shape[1])
                if int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum()) <= most_apart(int(nu[i]), int(nv[i]), percent):
                    good.append(i)
            yield batch.select(["u", "v", "nu", "nv"]).take(pa.array(good, pa.int64()))

    joined = pairs.join(one, "u").join(two, "v").select("u", "v", "nu", "nv", "su", "sv")
    return joined.mapInArrow(run, "u long, v long, nu long, nv long")


def _cut(sets: DataFrame, percent: int) -> DataFrame:
    """(node, pieces, fragment, items): each set in fragments, for every number of them that one of its pairs may have."""
    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                node, items = batch.column("node")[r].as_py(), _numbers(batch.column("items"), r)
                least = -(-len(items) * percent // 100)
                for pieces in sorted({pieces_of(least), pieces_of(len(items))}):
                    at = (items >> np.uint64(65 - pieces.bit_length())).astype(np.int64) if pieces > 1 else np.zeros(len(items), np.int64)
                    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                    parts = np.split(items, first[1:])
                    yield pa.record_batch({
                        "node": pa.array([node] * len(parts), pa.int64()), "pieces": pa.array([pieces] * len(parts), pa.int64()),
                        "fragment": pa.array(at[first]), "items": pa.array([p.tobytes() for p in parts], pa.binary())})

    return sets.select("node", "items").mapInArrow(run, "node long, pieces long, fragment long, items binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v, nu, nv) that share enough: overlaps are counted per fragment and added up per pair."""
    least = F.least("nu", "nv")
    pieces = F.pow(F.lit(2.0), F.ceil(F.log2(F.ceil(least / FRAGMENT)))).cast("long")
    rows = pairs.withColumn("pieces", pieces).withColumn("fragment", F.explode(F.expr("sequence(0L, pieces - 1)")))
    cut = _cut(sets, percent)
    one = cut.select(F.col("node").alias("u"), "pieces", "fragment", F.col("items").alias("iu"))
    two = cut.select(F.col("node").alias("v"), "pieces", "fragment", F.col("items").alias("iv"))

    def count(batches):
        for batch in batches:
            iu, iv = batch.column("iu"), batch.column("iv")
            both = [shared_count(_numbers(iu, i), _numbers(iv, i)) for i in range(batch.num_rows)]
            yield pa.record_batch([*(batch.column(c) for c in ("u", "v", "nu", "nv")), pa.array(both, pa.int64())],
                                  names=["u", "v", "nu", "nv", "both"])

    # A fragment that one of the two has nothing in adds nothing.
    met = rows.join(one, ["u", "pieces", "fragment"]).join(two, ["v", "pieces", "fragment"]).select("u", "v", "nu", "nv", "iu", "iv")
    partial = met.mapInArrow(count, "u long, v long, nu long, nv long, both long")
    total = partial.groupBy("u", "v", "nu", "nv").agg(F.sum("both").alias("both"))
    return total.filter(enough(F.col("both"), F.col("nu"), F.col("nv"), percent)).select("u", "v")


def _open_units(members: DataFrame, roots: DataFrame) -> DataFrame:
    """What the stars left open: (key, part, side, node, root) in blocks of bounded rows and n-grams.

    Rows whose root is the key's commonest one need no comparison with each other, so each block of the
    others (side 1) meets each block of all (side 0).
    """
    rooted = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    counts = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("g"))
    keys = counts.groupBy("key").agg(F.max(F.struct("c", "g", "root")).alias("top"), F.sum("c").alias("c"), F.sum("g").alias("g"),
                                     F.count(F.lit(1)).alias("roots")).filter("roots > 1")
    blocks = lambda c, g: F.greatest(F.ceil(c / BLOCK_ROWS), F.ceil(g / BLOCK_GRAMS))
    keys = settle(keys.select("key", F.col("top.root").alias("main"), blocks(F.col("c"), F.col("g")).alias("nb"),
                              blocks(F.col("c") - F.col("top.c"), F.col("g") - F.col("top.g")).alias("nr")))
    rows = rooted.join(keys, "key")
    block, of_rest = F.pmod(F.xxhash64("node"), F.col("nb")), F.pmod(F.xxhash64("node"), F.col("nr"))
    as_all = rows.withColumn("part", F.explode(F.transform(F.expr("sequence(0L, nr - 1)"), lambda r: r * F.col("nb") + block)))
    as_rest = rows.filter("root <> main").withColumn("part", F.explode(F.transform(F.expr("sequence(0L, nb - 1)"), lambda b: of_rest * F.col("nb") + b)))
    return as_all.withColumn("side", F.lit(0)).unionByName(as_rest.withColumn("side", F.lit(1))).select("key", "part", "side", "node", "root")


def _compared(table: pa.Table, percent: int, exact: bool) -> tuple[list[int], list[int]]:
    """Rows (i on side 1, j on side 0) of pairs with different roots that may be, or with ``exact`` are, linked.

    With ``exact``, roots joined on the way are not compared again.
    """
    side, n = table.column("side").to_numpy(), table.column("n").to_numpy()
    root = table.column("root").to_numpy().copy()
    names = ("sketch", "items") if exact else ("sketch",)
    held = {c: [np.frombuffer(x, np.uint64) for x in table.column(c).to_pylist()] for c in names}
    least = min(len(x) for x in held["sketch"])
    marks = np.concatenate([folded(x[None], least) for x in held["sketch"]])
    every, left, right = np.flatnonzero(side == 0), [], []
    for i in np.flatnonzero(side == 1).tolist():
        near = every[(root[every] != root[i]) & (100 * np.minimum(n[every], n[i]) >= percent * np.maximum(n[every], n[i]))]
        apart = (n[near] + n[i]) * (100 - percent) // (100 + percent)
        near = near[np.bitwise_count(marks[near] ^ marks[i]).sum(axis=1, dtype=np.int64) <= apart]
        if not exact:
            left += [i] * len(near)
            right += near.tolist()
            continue
        for j in near.tolist():
            if root[j] != root[i] and linked(held["items"][i], held["items"][j], percent):
                left.append(i)
                right.append(j)
                root[root == root[j]] = root[i]
    return left, right


def _more_links(members: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v: roots) between different components, from all comparisons that the stars left open."""
    def may(_, table):
        left, right = _compared(table, percent, exact=False)
        return table.select(["key", "part", "side", "node", "root"]).take(pa.array(sorted({*left, *right}), pa.int64()))

    def are(_, table):
        left, right = _compared(table, percent, exact=True)
        pick = lambda at: table.column("root").take(pa.array(at, pa.int64())).combine_chunks()
        return pa.table({"u": pick(left), "v": pick(right)})

    units = _open_units(members, roots).join(sets.select("node", "n", "sketch"), "node")
    maybe = settle(units.groupBy("key", "part").applyInArrow(lambda k, t: may(k, t), "key long, part long, side int, node long, root long"))
    return maybe.join(sets, "node").groupBy("key", "part").applyInArrow(lambda k, t: are(k, t), "u long, v long").distinct()


def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, percent: int = 90) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    A text's set is that of its runs of k words; texts are linked if their sets share ``percent`` of their union.
    component_id is the smallest id that links reach, its own included.

    Equal sets are one node from the start, however many texts have them. The order of all n-grams is cut into more
    fragments than linked sets can differ in, so linked sets have equal fragments: nodes that do meet. All are first compared with
    the node that meets most others; what is still apart after that is compared block by block, so no link between components
    is lost and no list of all pairs of a group is made. Sketches rule most pairs out without error, and links are confirmed by the
    overlaps of whole sets, counted per fragment and added up per pair.

    Null and empty texts, and white space, have no n-grams and link with nothing; each is its own component. Fewer than k words are
    one n-gram. A null id is larger than any other. Repeated rows are copies. An empty table gives no rows. Very long texts
    are whole; sets are compared in fragments of bounded size, but one task holds a text's set to cut it. Other columns are not read.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    # All that runs Python is stored inside.
    with settings(docs.sparkSession, BATCHES):
        return _similar_sets(docs, id_col, text_col, k, percent)


def _similar_sets(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn(
        "row_key", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    profiles = settle(_profiles(d, k, percent))
    least = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    # Numbers that are stored once are unique, as hashes need not be.
    nodes = settle(profiles.filter("n > 0").groupBy("digest").agg(F.min(least).alias("first"), F.first("n").alias("n"), F.first("keys").alias("keys"))
                   .withColumn("node", F.monotonically_increasing_id()))

    rows = nodes.select("node", "n", F.explode("keys").alias("key"))
    crowded = settle(rows.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"))
    members = settle(rows.join(crowded, "key"))
    # The original of many copies meets each of them most often, while two copies may differ too much from each other.
    met = settle(members.groupBy("node").agg(F.sum("m").alias("met")))
    centers = settle(members.join(met, "node").groupBy("key").agg(F.max(F.struct("met", "node")).alias("top")).select("key", F.col("top.node").alias("center")))
    stars = settle(members.join(centers, "key").filter("node <> center").select(F.col("center").alias("u"), F.col("node").alias("v")).distinct())
    sets = _sets(d, settle(nodes.join(met, "node").select("node", "digest", F.col("first.row_key").alias("row_key"))), k)
    links = settle(_verified(settle(_close(stars, sets, percent)), sets, percent))
    roots = components(links)
    more = settle(_more_links(members.filter("m > 2").select("key", "node", "n"), roots, sets, percent))
    if not more.isEmpty():
        roots = components(links.unionByName(more))

    of_node = nodes.join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("root"), "first")
    named = settle(of_node.groupBy("root").agg(F.min("first.doc_id").alias("component_id")))
    of_node = of_node.join(named, "root").select("digest", "component_id")
    out = profiles.filter("n > 0").select("doc_id", "n", "digest").join(of_node, "digest").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.unionByName(profiles.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
