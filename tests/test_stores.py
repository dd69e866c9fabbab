"""SQLite scans, snapshots, chapters from units and near vectors: against plain Python."""

import sqlite3

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlake.operators import clusters, vectors
from claimlake.sources import chapters, snapshots, sqlite


@pytest.fixture
def store(tmp_path):
    path = str(tmp_path / "a store.db")
    con = sqlite3.connect(path)
    con.execute('CREATE TABLE works (id INTEGER PRIMARY KEY, title TEXT, score REAL, raw BLOB, "odd ""name" VARCHAR(9), free)')
    con.executemany("INSERT INTO works VALUES (?, ?, ?, ?, ?, ?)", [(i, f"t{i % 7}" if i % 5 else None, i / 4 if i % 3 else None, bytes([i % 256]), "x", 1 if i % 2 else "s") for i in range(3, 2503)])
    con.execute("CREATE TABLE none (a INTEGER)")
    con.commit()
    con.close()
    return path


def test_sqlite_scan_hands_filters_to_the_file(spark, store):
    df = sqlite.scan(spark, store, "works", rows=400)
    assert df.count() == 2500 and df.rdd.getNumPartitions() == 7
    assert dict(df.dtypes) == {"id": "bigint", "title": "string", "score": "double", "raw": "binary", 'odd "name': "string", "free": "string"}
    some = sqlite.scan(spark, store, "works", [("title", "=", "t1"), ("id", ">", 1000), ("score", "is not", None)])
    assert {r.id for r in some.collect()} == {i for i in range(1001, 2503) if i % 5 and i % 7 == 1 and i % 3} and some.filter("id < 1200").count() < some.count()
    assert sqlite.scan(spark, store, "works", [("id", "in", [3, 4, 9999])]).count() == 2 and sqlite.scan(spark, store, "works", [("title", "is", None)]).count() == 500
    assert df.filter("id = 3").first().raw == b"\x03" and df.filter("id = 3").first().free == "1" and df.count() == 2500
    assert sqlite.scan(spark, store, "none").count() == 0


def test_sqlite_statement(store):
    reader = sqlite._Reader(store, "works", 1000, [("title", "=", "t1"), ("id", "in", [1, 2]), ("score", "is not", None)])
    sql, values = reader.statement(sqlite.RowIds(0, 10))
    assert sql.endswith('WHERE rowid >= ? AND rowid < ? AND "title" = ? AND "id" IN (?, ?) AND "score" IS NOT NULL') and values == [0, 10, "t1", 1, 2]
    assert [(p.low, p.high) for p in reader.partitions()] == [(3, 1003), (1003, 2003), (2003, 2503)]
    for bad in (("none", "=", 1), ("id", "; DROP", 1), ("id", "is", 3)):
        with pytest.raises(ValueError):
            sqlite._Reader(store, "works", 1000, [bad])


def test_absence_is_stated(spark, store, tmp_path, monkeypatch):
    monkeypatch.setattr(sqlite, "PATIENCE", 0.1)
    assert sqlite.absence(store) is None and sqlite.absence(str(tmp_path / "no")) == "missing"
    (tmp_path / "junk").write_bytes(b"no database" * 500)
    assert sqlite.absence(str(tmp_path / "junk")) == "unreadable"
    con = sqlite3.connect(store, isolation_level=None)
    con.execute("BEGIN EXCLUSIVE")
    assert sqlite.absence(store) == "locked"
    with pytest.raises(ValueError, match="locked"):
        sqlite.scan(spark, store, "works")
    con.close()
    with pytest.raises(sqlite3.OperationalError, match="readonly"):
        sqlite.opened(store).execute("DELETE FROM works")


def test_snapshots_are_whole_or_not_there(spark, tmp_path):
    df = spark.createDataFrame([(i, f"v{i}" if i % 3 else None) for i in range(500)] + [(None, "n")], "id long, v string")
    path = str(tmp_path / "s1")
    digest = snapshots.write(df, path, "id", chunks=7, run="r1")
    again = snapshots.read(spark, path)
    assert sorted(map(str, again.collect())) == sorted(map(str, df.collect())) and again.schema == df.schema
    assert snapshots.mark(spark, path)["digest"] == digest and snapshots.mark(spark, path)["run"] == "r1"
    assert snapshots.write(df.orderBy(F.desc("id")), str(tmp_path / "s2"), "id", chunks=7) == digest
    with pytest.raises(Exception, match="(?i)exist"):
        snapshots.write(df, path, "id")
    killed = df.withColumn("v", F.when(F.col("id") == 77, F.raise_error(F.lit("killed"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="killed"):
        snapshots.write(killed, str(tmp_path / "s3"), "id", chunks=7)
    with pytest.raises(ValueError, match="no whole snapshot"):
        snapshots.read(spark, str(tmp_path / "s3"))
    df.limit(1).withColumn("chunk", F.lit(3)).write.partitionBy("chunk").mode("append").parquet(f"{tmp_path}/s2/rows")
    with pytest.raises(ValueError, match=r"chunks \[3\]"):
        snapshots.read(spark, str(tmp_path / "s2"))
    live = spark.createDataFrame([(1, "live")], df.schema)
    with pytest.raises(ValueError, match="chunks"):
        snapshots.restore(spark, str(tmp_path / "s2"), live, "id", str(tmp_path / "never"))
    assert snapshots.mark(spark, str(tmp_path / "never")) is None
    back = snapshots.restore(spark, path, live, "id", str(tmp_path / "before"), chunks=2)
    assert back.count() == 501 and [tuple(r) for r in snapshots.read(spark, str(tmp_path / "before")).collect()] == [(1, "live")]


UNIT = "work string, pos int, spine string, label string, text string"


def test_short_units_are_joined_and_long_ones_cut(spark):
    para = " ".join(f"word{i}" for i in range(100))
    chapter = "\n\n".join([para] * 6)
    big = "\n\n".join([para * 2] * 40)
    units = [
        ("b", 0, "cover.xhtml", "", "cover " * 400), ("b", 1, "x.xhtml", "Contents", "link " * 400), ("b", 2, "copyright.xhtml", None, "c " * 900),
        ("b", 3, "ch01.xhtml", "First Chapter", chapter), ("b", 4, "ch02.xhtml", None, "tiny interlude " * 14), ("b", 5, "ch03.xhtml", "Third Chapter", chapter),
        ("b", 6, "ch04.xhtml", "Big Chapter", big), ("b", 7, "about-author.xhtml", "About the Author", "bio " * 500), ("b", 8, "end.xhtml", "Last words", "brief"), ("b", 9, "nil.xhtml", "Nil", "  "),
        ("tiny", 0, "a.xhtml", None, "x" * 200), ("tiny", 1, "b.xhtml", None, "y" * 300), ("matter", 0, "toc.xhtml", None, "z" * 5000),
    ]
    got = {}
    for r in sorted(chapters.split_chapters(spark.createDataFrame(units, UNIT).repartition(3), "work", "pos").collect(), key=lambda r: r["index"]):
        got.setdefault(r.work, []).append((r["index"], r.label, r.text))
    assert set(got) == {"b", "tiny"} and got["tiny"] == [(1, "b.xhtml", "x" * 200 + "\n\n" + "y" * 300)]
    labels = [n for _, n, _ in got["b"]]
    assert labels[:2] == ["First Chapter", "Third Chapter"] and labels[2] == "Big Chapter" and labels[3] == "Big Chapter (part 2)"
    assert "tiny interlude" in got["b"][1][2] and [i for i, _, _ in got["b"]] == list(range(1, len(labels) + 1))
    assert all(len(t) <= chapters.MOST for _, _, t in got["b"]) and "".join(t for _, _, t in got["b"]).replace("\n", "") == "".join(u[4] for u in units if u[0] == "b" and u[1] in (3, 4, 5, 6, 8)).replace("\n", "")


def test_groups_close_when_short_units_add_up(spark):
    sizes = [500, 600, 500, 100, 2000, 10, 20]
    df = spark.createDataFrame([("w", i, n) for i, n in enumerate(sizes)] + [("v", 0, 5)], "work string, pos int, n int")
    assert {(r.work, r.pos): r.chapter for r in chapters.grouped(df, "work", "pos", "n").collect()} == {("w", 0): 1, ("w", 1): 1, ("w", 2): 1, ("w", 3): 2, ("w", 4): 2, ("w", 5): 2, ("w", 6): 2, ("v", 0): 1}


def test_cuts_and_headings(spark):
    assert chapters.cut("aa\n\nbb\n\ncc", 6) == ["aa\n\nbb", "cc"] and chapters.cut("aa bb cc", 5) == ["aa bb", "cc"] and chapters.cut("x" * 7, 3) == ["xxx", "xxx", "x"] and chapters.cut("", 3) == [""]
    text = "A word before.\nChapter One: The Fall\nIt fell.\n\nCHAPTER II\n\nIt rose, said chapter 3 of it.\nEpilogue\nDone."
    assert chapters.prose_units(text) == [("Opening", "A word before.\n"), ("Chapter One: The Fall", "It fell."), ("CHAPTER II", "It rose, said chapter 3 of it."), ("Epilogue", "Done.")]
    df = spark.createDataFrame([("a", text), ("b", None), ("c", "plain " * 3000), ("d", " ")], "work string, text string")
    got = chapters.prose_chapters(df, "work").collect()
    assert sum(r.work == "a" for r in got) == 4 and [r.label for r in got if r.work == "c"] == ["Part 1", "Part 2", "Part 3"] and not any(r.work in "bd" for r in got)


@pytest.mark.parametrize("pivots", [1, 7, 64])
def test_near_pairs_are_all_of_them(spark, monkeypatch, pivots):
    monkeypatch.setattr(vectors, "PIECE", 40)
    rng = np.random.default_rng(pivots)
    centres = rng.normal(0, 1, (6, 8))
    v = np.concatenate([centres[rng.integers(0, 6, 250)] + rng.normal(0, 0.3, (250, 8)), rng.normal(0, 1, (50, 8))])
    v[7] = v[3]
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)] + [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(5)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    cos = unit @ unit.T
    for least in (0.35, 0.85, 0.98):
        got = [(r.a, r.b) for r in vectors.near_pairs(df, "id", "v", least, pivots).collect()]
        want = {(i, j) for i in range(300) for j in range(i + 1, 300) if cos[i, j] >= least}
        assert len(got) == len(set(got)) and set(got) == want
    assert vectors.near_pairs(df.filter("id > 900"), "id", "v", 0.5).collect() == []


def test_two_signals_and_catalog(spark):
    people = spark.createDataFrame([(1, "ann", "f"), (2, "ann", "f"), (3, "bo", "m"), (4, "", "m"), (5, "", None), (6, "cy", "f")], "node long, name string, gender string")
    pairs = spark.createDataFrame([(1, 2, 0.9), (2, 3, 0.9), (3, 4, 0.9), (4, 5, 0.9), (5, 6, 0.9), (1, 6, 0.86)], "a long, b long, cosine double")
    links = vectors.two_signal_links(people, pairs, "node", "name", allowed=F.col("a_gender") == F.col("b_gender"))
    assert sorted(map(tuple, links.collect())) == [(1, 2, "name"), (1, 6, "vector"), (3, 4, "vector"), (4, 5, "vector"), (5, 6, "vector")]
    assert {(r.node, r.root) for r in clusters.components(links).collect()} == {(n, 1) for n in range(1, 7)}
    catalog = spark.createDataFrame([("found family", [1.0, 0.0]), ("quest", [0.0, 1.0]), ("also quest", [0.0, 2.0]), ("none", [])], "name string, v array<double>")
    rows = spark.createDataFrame([(1, [5.0, 0.1]), (2, [0.0, 3.0]), (3, [1.0, 1.0]), (4, None), (5, [1.0])], "id long, v array<double>")
    got = {r.id: r.name for r in vectors.best_in_catalog(rows, catalog, "id", "name", "v", 0.78).collect()}
    assert got == {1: "found family", 2: "also quest", 3: None, 4: None, 5: None}


def test_near_pairs_hold_a_chunk_of_visitors(spark, monkeypatch):
    """No grouped table: all visitors of a cell stood in one before, however many. Ids are multiples of what pieces are counted by."""
    monkeypatch.setattr(vectors, "PIECE", 16)
    monkeypatch.setattr(vectors, "CHUNK", 7)
    rnd = np.random.default_rng(5)
    v = rnd.normal(size=(300, 6))
    df = spark.createDataFrame([(i * 96, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    pairs = vectors.near_pairs(df, "id", "v", 0.7, 4)
    assert "FlatMapGroupsInArrow" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    u = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
    i, j = np.nonzero(np.triu(u @ u.T >= 0.7, 1))
    assert sorted((r.a, r.b) for r in pairs.collect()) == sorted(zip((i * 96).tolist(), (j * 96).tolist(), strict=True))
