"""Near-duplicates by MinHash with tensored banding; candidates confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import buffers, forget, mixed, slices, span_hashes, stored, words_of

#: Two collections of SIDE half keys, each of HASHES minima; a table for each pair of half keys: SIDE ** 2 tables from 2 * SIDE * HASHES minima.
SIDE, HASHES = 8, 3
#: Rows of wanted classes up to which they are broadcast; joined by hash beyond.
BROADCAST_ROWS = 5_000_000
#: Shingles of the other texts of a star; a larger star is split.
LOAD = 1 << 18
#: Bits that stand for a set before its text is read; classes of a bucket that are compared in one task at once.
BITS, CHUNK = 2048, 4096
SIGNATURES = "doc_id long, n_shingles long, f1 long, f2 long, left array<long>, right array<long>"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingles(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of n-word shingles, sorted by text, and len + 1 offsets. Under n words: the whole sequence as one."""
    data, offsets = buffers(texts)
    low = _LOWER[data]
    starts, ends, text = words_of(low, offsets)
    words = span_hashes(low, starts, ends)
    m = max(0, len(words) - n + 1)
    rolled = np.zeros(m, np.uint64)
    for i in range(n):
        rolled = mixed(rolled + words[i : i + m])
    own = text[:m] == text[n - 1 :]
    count = np.bincount(text, minlength=len(offsets) - 1)
    few = [(t, i) for t, i in zip(np.flatnonzero((count > 0) & (count < n)).tolist(), np.searchsorted(text, np.flatnonzero((count > 0) & (count < n))).tolist(), strict=True)]
    extra = []
    for t, i in few:
        h = np.uint64(count[t])
        for w in words[i : i + count[t]]:
            h = mixed(np.array([h + w], np.uint64))[0]
        extra.append(h)
    hashes = np.concatenate([rolled[own], np.array(extra, np.uint64)])
    owner = np.concatenate([text[:m][own], np.array([t for t, _ in few], np.int64)])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.searchsorted(owner[new], np.arange(len(offsets)))


def fingerprints(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Two 64-bit sums over each set of shingles; 0 for empty sets."""
    size = np.diff(at)
    full, marks = size > 0, np.zeros((2, len(size)), np.uint64)
    if len(h):
        marks[0, full] = np.add.reduceat(mixed(h), at[:-1][full])
        marks[1, full] = np.add.reduceat(mixed(h ^ np.uint64(0x5851F42D4C957F2D)), at[:-1][full])
    return marks


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """Set size, 128-bit fingerprint of the set, and both collections of half keys of every whole text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rng = np.random.default_rng(9)
    salts = rng.integers(0, 2**63, 2 * SIDE * HASHES, dtype=np.uint64)
    mults = rng.integers(0, 2**63, 2 * SIDE * HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in slices(big, "text", 1 << 20):
                h, at = shingles(batch.column(1), n)
                size = np.diff(at)
                full = size > 0
                marks = fingerprints(h, at)
                half = np.zeros((2 * SIDE, len(size)), np.uint64)
                if len(h):
                    heads = at[:-1][full]
                    for i in range(len(salts)):
                        x = (h ^ salts[i]) * mults[i]
                        least = np.minimum.reduceat(x ^ (x >> np.uint64(32)), heads)
                        half[i // HASHES, full] = mixed(half[i // HASHES, full] + least)
                keys = [pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1) * SIDE, pa.int32()), pa.array(np.ascontiguousarray(half[a : a + SIDE].T).view(np.int64).ravel())) for a in (0, SIDE)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), *(pa.array(x.view(np.int64)) for x in marks), *keys], names=["doc_id", "n_shingles", "f1", "f2", "left", "right"])

    return rows.mapInArrow(run, SIGNATURES)


def parities(h: np.ndarray, at: np.ndarray) -> pa.Array:
    """For each set, how many of its shingles fall into each of BITS bins, odd or even, as BITS // 64 integers.

    Two sets differ in as many shingles at least as their bits differ in places, so bits bound what they can share.
    """
    out = []
    for i in range(0, len(at) - 1, 512):
        last = min(i + 512, len(at) - 1)
        own = h[at[i] : at[last]]
        row = np.repeat(np.arange(last - i), np.diff(at[i : last + 1]))
        odd = np.bincount(row * BITS + (own & np.uint64(BITS - 1)).astype(np.int64), minlength=(last - i) * BITS) & 1
        out.append(np.packbits(odd.astype(bool)).view(np.int64))
    flat = np.concatenate([np.zeros(0, np.int64), *out])
    return pa.ListArray.from_arrays(pa.array(np.arange(len(at)) * (BITS // 64), pa.int32()), pa.array(flat))


def looked_up(classes: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """cls, size, bits, text: one text of each class (cls, least, f1, f2), whatever other texts its smallest doc_id has."""
    wanted = classes.select(F.col("least").alias("doc_id"), "cls", "f1", "f2")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in slices(big, "text", 1 << 20):
                h, at = shingles(batch.column(3), n)
                marks = fingerprints(h, at).view(np.int64)
                own = (marks[0] == np.asarray(batch.column(1))) & (marks[1] == np.asarray(batch.column(2)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(at)), parities(h, at), batch.column(3)], names=["cls", "size", "bits", "text"]).filter(pa.array(own))

    found = docs.join(wanted, "doc_id").select("cls", "f1", "f2", F.coalesce("text", F.lit("")).alias("text"))
    return found.mapInArrow(run, "cls long, size long, bits array<long>, text string").dropDuplicates(["cls"])


def confirmed(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets have 100 * intersection >= percent * union.

    Pairs whose sizes or bits forbid it go first. Each a's text then stands before the texts of its bs in a sorted partition;
    an a whose bs hold more than LOAD shingles is split into several such stars, so its text is copied once for each
    of these and not for each pair.
    """
    for x in "ab":
        pairs = pairs.join(texts.select(F.col("cls").alias(x), F.col("size").alias("s" + x), F.col("bits").alias("b" + x)), x)
    apart = F.aggregate(F.zip_with("ba", "bb", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda n, k: n + k)
    both = F.col("sa") + F.col("sb")
    near = pairs.filter((100 * F.least("sa", "sb") >= percent * F.greatest("sa", "sb")) & ((100 + percent) * (both - apart) >= 2 * percent * both))
    near = stored(near.select("a", "b", "sb"), "near")
    stars = near.groupBy("a").agg(F.expr(f"sum(sb) div {LOAD} + 1").alias("parts"))
    heads = stars.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")).join(texts.select(F.col("cls").alias("a"), "text"), "a")
    dealt = near.join(stars, "a").select("a", F.pmod(F.xxhash64("b"), "parts").alias("part"), "b")
    rays = dealt.join(texts.select(F.col("cls").alias("b"), "text"), "b")
    both = heads.select("a", "part", F.lit(None).cast("long").alias("b"), "text").union(rays.select("a", "part", "b", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = np.zeros(0, np.uint64)
        for big in batches:
            for batch in slices(big, "text", 1 << 20):
                h, at = shingles(batch.column(3), n)
                keep = []
                for i, b in enumerate(batch.column(2).to_pylist()):
                    own = h[at[i] : at[i + 1]]
                    if b is None:
                        head = own
                        keep.append(False)
                        continue
                    common = len(np.intersect1d(head, own, assume_unique=True))
                    keep.append(100 * common >= percent * (len(head) + len(own) - common))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    links = stored(both.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first()).mapInArrow(run, "a long, b long"), "links")
    forget(near)
    return links


def components(links: DataFrame) -> DataFrame:
    """node, root (its smallest reachable node) of every node with a link (a, b): large and small stars in turn until nothing changes."""
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().filter("u > v"), "edges")
    before = None
    while True:
        sides = edges.union(edges.select(F.col("v"), F.col("u")))
        least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sides.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select("u", F.col("m").alias("v")).union(small.select(F.col("v").alias("u"), F.col("m").alias("v"))).filter("u > v").distinct()
        last, edges = edges, stored(small, "edges")
        forget(last)
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def joined_roots(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """node, root after more links: components of the roots that the links join, carried to all nodes."""
    if roots is None:
        return stored(components(links), "roots")
    for x in "ab":
        links = links.join(roots.select(F.col("node").alias(x), F.col("root").alias("r" + x)), x, "left").withColumn("r" + x, F.coalesce("r" + x, x))
    links = stored(links, "joined")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct().join(roots, "node", "left_anti").select("node", F.col("node").alias("root"))
    joined = components(links.select(F.col("ra").alias("a"), F.col("rb").alias("b")).filter("a <> b")).select(F.col("node").alias("root"), F.col("root").alias("top"))
    out = stored(roots.union(nodes).join(joined, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "roots")
    forget(links, roots)
    return out


def compared_in_buckets(members: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of classes that share a bucket of members (key, cls, root), have different roots, and whose sizes and bits allow a link.

    Buckets are compared inside tasks, so only what passes becomes a row. A bucket of more than CHUNK classes is dealt
    into parts, and each two of these meet in a group of their own.
    """
    parts = members.groupBy("key").agg(F.expr(f"(count(1) - 1) div {CHUNK} + 1").alias("parts"))
    dealt = members.join(parts, "key").withColumn("own", F.pmod(F.xxhash64("cls"), "parts")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    rows = dealt.join(texts.select("cls", "size", "bits"), "cls").select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cls", "root", "size", "bits")

    def pairs(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, cls, root, size = (np.asarray(batch.column(k)) for k in (3, 4, 5, 6))
        bits = np.asarray(batch.column(7).flatten()).view(np.uint64).reshape(len(own), -1)
        by = np.argsort(size, kind="stable")
        own, cls, root, size, bits = own[by], cls[by], root[by], size[by], bits[by]
        across = batch.column(1)[0] != batch.column(2)[0]
        out = []
        ends = np.searchsorted(size, size * 100 // percent, "right")
        for x in range(len(own)):
            to = slice(x + 1, ends[x])
            some = np.flatnonzero((root[to] != root[x]) & ((own[to] != own[x]) if across else True)) + x + 1
            apart = np.bitwise_count(bits[some] ^ bits[x]).sum(axis=1, dtype=np.int64)
            total = size[some] + size[x]
            some = some[(100 + percent) * (total - apart) >= 2 * percent * total]
            out.append((np.minimum(cls[x], cls[some]), np.maximum(cls[x], cls[some])))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *(p[k] for p in out)])) for k in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        mark = None
        for batch in batches:
            group = np.stack([np.asarray(batch.column(k)) for k in range(3)])
            cuts = [0, *(np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                if x == y:
                    continue
                if held and mark != tuple(group[:, x]):
                    yield pairs(pa.concat_batches(held))
                    held = []
                mark = tuple(group[:, x])
                held.append(batch.slice(x, y - x))
        if held:
            yield pairs(pa.concat_batches(held))

    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, n: int = 2, percent: int = 80, rounds: int = 3) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links) and kept of every document.

    docs: doc_id, text; other columns are ignored. Words are lower-cased in A-Z. Texts with equal sets are one class
    and one row from then on. Classes that share a table key are candidates: each against the first class of its
    bucket, then, for up to rounds rounds and only in buckets of three or more that still hold several components,
    against the class that another order puts first. In buckets that hold several components after that, all classes of
    different components are compared (compared_in_buckets), so any two linked classes that share a table key end in
    one component, however many rounds there were. Null, empty and blank texts: n_shingles 0, linked
    with nothing, kept. Null doc_id: component null, kept. Rows of one doc_id with different texts are different nodes
    and each has the component of its own text. No rows: no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sig = stored(signatures(docs, n), "signatures")
    live = sig.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = live.groupBy("f1", "f2").agg(F.min("doc_id").alias("least"), F.first("left").alias("left"), F.first("right").alias("right"))
    classes = stored(classes.orderBy("least", "f1").withColumn("cls", F.monotonically_increasing_id()), "classes")  # classes of older documents come first: they are the likelier sources of copies
    keys = classes.select("cls", F.posexplode("left").alias("i", "x"), "right").select("cls", "i", "x", F.posexplode("right").alias("j", "y")).select(F.xxhash64("i", "x", "j", "y").alias("key"), "cls")
    shared = keys.groupBy("key").agg(F.min("cls").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = stored(keys.join(shared, "key"), "members")
    texts = stored(looked_up(classes.select("cls", "least", "f1", "f2").join(members.select("cls").distinct(), "cls", "left_semi"), docs, n), "texts")
    done = stored(members.filter("cls > a").select("a", F.col("cls").alias("b")).distinct(), "pairs")
    roots = joined_roots(None, confirmed(done, texts, n, percent))
    members, first = stored(members.filter("n > 2").select("key", "cls"), "members"), members
    forget(first)
    named = with_roots(members, roots)
    for r in range(1, rounds):
        order = F.struct(F.xxhash64("root", "key", F.lit(r)), F.xxhash64("cls", F.lit(r)))
        centres = named.groupBy("key").agg(F.min_by("cls", order).alias("c"), F.min_by("root", order).alias("c_root"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
        last, members = members, stored(named.join(centres, "key").select("key", "cls", "root", "c", "c_root"), "members")
        forget(last)
        named = members.select("key", "cls", "root")
        more = members.filter("root <> c_root").select(F.least("cls", "c").alias("a"), F.greatest("cls", "c").alias("b")).distinct()
        more = stored(more.join(done, ["a", "b"], "left_anti"), "pairs")
        if more.isEmpty():
            break
        done = done.union(more)
        roots = joined_roots(roots, confirmed(more, texts, n, percent))
        named = with_roots(members.select("key", "cls"), roots)
    several = named.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
    rest = stored(named.join(several, "key", "left_semi"), "rest")
    if not rest.isEmpty():
        more = stored(compared_in_buckets(rest, texts, percent).join(done, ["a", "b"], "left_anti"), "pairs")
        roots = joined_roots(roots, confirmed(more, texts, n, percent))
    forget(texts, members, rest)
    named = with_roots(classes.select("f1", "f2", "least", "cls"), roots)
    named = named.join(named.groupBy("root").agg(F.min("least").alias("component")), "root").select("f1", "f2", "component")
    ok = F.col("n_shingles") > 0
    return sig.select("doc_id", "n_shingles", F.when(ok, F.col("f1")).alias("f1"), F.when(ok, F.col("f2")).alias("f2")).join(named, ["f1", "f2"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"), F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def with_roots(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """rows (cls) with their root; a class without links is its own."""
    return rows.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
