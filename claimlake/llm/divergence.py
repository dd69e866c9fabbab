"""Source divergence audit: how far the term shares of a language's sources lie apart, by a cube of (group block, group block, term block) cells."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import forget, stored

#: Groups and terms of a cell's sides, on average.
GROUPS, TERMS = 256, 4096
#: Terms that a task holds before it passes on what it counted, and bytes of a text that are cut into terms at once.
MOST_HELD, PIECE = 200_000, 1 << 20
#: Rows of kept terms or groups up to which they are broadcast; joined by hash beyond.
BROADCAST_ROWS = 500_000

#: Bytes outside terms become spaces, A-Z become a-z; bytes of signs beyond ASCII stay.
_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a piece at a time."""
    plain, at = text.translate(_TERM_BYTES), 0
    while at < len(plain):
        to = at + PIECE
        if to < len(plain):
            cut = plain.rfind(b" ", at, to)
            to = cut if cut > at else plain.find(b" ", to)
            to = len(plain) if to < 0 else to
        yield plain[at:to].split()
        at = max(to, at + 1)


def counted(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (rows that hold it); the term '' stands for the group itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def flush():
            for (lang, source), (n, docs) in held.items():
                terms = [b"", *n]
                columns = [pa.array([lang]).take(pa.array(np.zeros(len(terms), np.int64))), pa.array([source]).take(pa.array(np.zeros(len(terms), np.int64)))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(terms, pa.binary()).cast(pa.string()), pa.array([0, *n.values()], pa.int64()), pa.array([0, *(docs[t] for t in n)], pa.int64())], names=["lang", "source", "term", "n", "docs"])
            held.clear()

        for batch in batches:
            for lang, source, text in zip(batch.column(0), batch.column(1), batch.column(2).cast(pa.binary()), strict=True):
                n, docs = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
                before, seen = len(n), set()
                for terms in _pieces(text.as_py()):
                    n.update(terms)
                    seen.update(terms)
                docs.update(seen)
                size += len(n) - before
                if size > MOST_HELD:
                    yield from flush()
                    size = 0
        yield from flush()

    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    return rows.mapInArrow(run, "lang string, source string, term string, n long, docs long").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _sized(df: DataFrame) -> DataFrame:
    """df, to be broadcast if it is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _share(count: str, total: str, scale: int, weight: int):
    """1 + floor(scale * (count + weight) / (total + weight * terms)), in decimals, which cannot overflow."""
    return F.expr(f"IF(terms = 0, 0L, 1 + ({scale}BD * ({count} + {weight})) div ({total} + {weight} * terms))").cast("long")


def _cell(table: pa.Table) -> pa.Table:
    """Partial divergences of the pairs of two blocks of groups over one block of terms.

    Rows of term -1 give each group's share of terms that it lacks (p) and, in one block of terms, how many terms are
    kept in all (terms): every pair starts from their difference over all of these, and cells correct it term by term.
    """
    block, a, b, group, term, p, terms = (np.asarray(table[c].combine_chunks()) for c in ("block", "a", "b", "group", "term", "p", "terms"))
    names = np.unique(term[term >= 0])

    def side(at: int):
        own = block == at
        base = own & (term < 0)
        by = np.argsort(group[base])
        groups, lacking, kept = group[base][by], p[base][by], terms[base][by]
        dense = np.repeat(lacking[:, None], len(names), axis=1)
        some = own & (term >= 0)
        dense[np.searchsorted(groups, group[some]), np.searchsorted(names, term[some])] = p[some]
        return groups, lacking, kept, dense

    left, right = side(a[0]), side(b[0])
    one, other, partial = ([np.zeros(0, np.int64)] for _ in range(3))
    for i, g in enumerate(left[0]):
        to = slice(i + 1 if a[0] == b[0] else 0, None)
        sums = np.abs(right[3][to] - left[3][i]).sum(axis=1) + (left[2][i] - len(names)) * np.abs(right[1][to] - left[1][i])
        one.append(np.full(len(sums), g))
        other.append(right[0][to])
        partial.append(sums)
    return pa.table({"one": np.concatenate(one), "other": np.concatenate(other), "partial": np.concatenate(partial)})


def audit(docs: DataFrame, least_docs: int = 30, scale: int = 1_000_000_000, weight: int = 5, most: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank: each source beside the others of its language (part pair) and beside its language (part term).

    docs: text, lang, source; other columns are ignored. Null text, lang, source: ''. Terms: runs of ASCII letters,
    lower-cased, and signs beyond ASCII. A language keeps the terms in at least least_docs of its rows; a repeated row
    counts each time. Shares: 1 + floor(scale * (count + weight) / (all + weight * kept terms)), all arithmetic in
    integers. pair: the sum of absolute differences over all kept terms, 0 without any, every rank; a source alone in
    its language has none. term: kept terms that the source holds more often than its language, most of them at most.
    Ranks by value, then by the item's UTF-8 bytes. No rows: no rows.

    Groups and terms are dealt into blocks by hash. A cell of the cube owns two blocks of groups and one of terms: it
    gets both slices of shares, and its partial sums are reduced along the terms. Terms that neither group holds are
    never written out. Counting is done before the first shuffle, so a source with most rows costs a task one row a term.
    """
    counts = stored(counted(docs), "term-counts")
    kept = counts.filter("term <> ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).filter(F.col("docs") >= least_docs)
    kept = stored(kept.select(F.col("lang").alias("l"), F.col("term").alias("t"), "lang_n", F.monotonically_increasing_id().alias("term_id")), "kept-terms")
    cells = stored(counts.filter("n > 0").join(_sized(kept), (F.col("lang") == F.col("l")) & (F.col("term") == F.col("t"))).select("lang", "source", "term", "n", "lang_n", "term_id"), "kept-counts")
    totals = _sized(kept.groupBy("l").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_all")))
    own = _sized(cells.groupBy(F.col("lang").alias("l2"), F.col("source").alias("s2")).agg(F.sum("n").alias("all")))
    groups = counts.filter("term = ''").select("lang", "source")
    in_lang = _sized(groups.groupBy(F.col("lang").alias("l3")).agg(F.count(F.lit(1)).alias("groups")))
    groups = groups.join(own, (F.col("lang") == F.col("l2")) & (F.col("source") == F.col("s2")), "left").join(totals, F.col("lang") == F.col("l"), "left").join(in_lang, F.col("lang") == F.col("l3"))
    groups = groups.select("lang", "source", F.monotonically_increasing_id().alias("group"), *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("all", "terms", "lang_all")), F.ceil(F.col("groups") / GROUPS).alias("sides"))
    groups = stored(groups.withColumn("depth", F.greatest(F.lit(1), F.ceil(F.col("terms") / TERMS))).withColumn("block", F.pmod(F.xxhash64("group"), "sides")).withColumn("lacking", _share("0", "all", scale, weight)), "groups")

    named = _sized(groups)
    shares = cells.join(named.withColumnsRenamed({"lang": "l", "source": "s"}), (F.col("lang") == F.col("l")) & (F.col("source") == F.col("s")))
    shares = shares.withColumn("p", _share("n", "all", scale, weight))
    entries = shares.select("lang", "sides", "block", F.pmod(F.xxhash64("term_id"), "depth").alias("layer"), "group", F.col("term_id").alias("term"), "p", F.lit(0).cast("long").alias("terms"))
    bases = groups.select("lang", "sides", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("depth") - 1)).alias("layer"), "group", F.lit(-1).cast("long").alias("term"), F.col("lacking").alias("p"), "terms")
    bases = bases.withColumn("terms", F.when(F.col("layer") == 0, F.col("terms")).otherwise(0))
    slices = entries.unionByName(bases).withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), F.col("sides") - 1)))
    slices = slices.select("lang", "layer", "block", F.least("block", "met").alias("a"), F.greatest("block", "met").alias("b"), "group", "term", "p", "terms")
    partial = slices.groupBy("lang", "layer", "a", "b").applyInArrow(_cell, "one long, other long, partial long")
    sums = stored(partial.groupBy("one", "other").agg(F.sum("partial").alias("value")), "divergences")
    both = sums.select(F.col("one").alias("group"), "other", "value").union(sums.select("other", "one", "value"))
    pairs = both.join(named.select("group", "lang", "source"), "group").join(named.select(F.col("group").alias("other"), F.col("source").alias("item")), "other").select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pairs.withColumn("rank", rank)
    above = shares.withColumn("q", _share("lang_n", "lang_all", scale, weight)).filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    above = above.withColumn("rank", rank).filter(F.col("rank") <= most)
    return pairs.unionByName(above)


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
o AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term, CAST(count(*) AS HUGEINT) AS c FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
l AS (SELECT lang, count(*) AS v, sum(c) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS c FROM o SEMI JOIN k USING (lang, term) GROUP BY ALL),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, 1 + 1000000000 * (coalesce(c.c, 0) + 5) // (coalesce(n.n, 0) + 5 * l.v) AS p,
    1 + 1000000000 * (k.c + 5) // (l.n + 5 * l.v) AS q
  FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
x AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
y AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q),
z AS (SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM y)
SELECT * FROM z WHERE part = 'pair' OR rank <= 50
"""
