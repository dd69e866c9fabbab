"""Live runs: streams give what tables give, restarts resume, the first verdict is final, silences interrupt."""

import json

import pytest
from pyspark.sql import functions as F

from claimlake.sources import jsonlines, tail
from claimlake.streaming import console


@pytest.fixture
def rocks(spark):
    key, before = "spark.sql.streaming.stateStore.providerClass", spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.set(key, before)


def run(stream, name, at, mode="update"):
    """Everything that a stream has, appended to a table in memory."""
    rows = []

    def keep(batch, _):
        rows.extend(tuple(r) for r in batch.collect())

    q = stream.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", str(at)).start()
    q.processAllAvailable()
    q.stop()
    return rows


def test_tail_hands_out_each_ended_line_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tail, "STEP", 7)
    path, at = tmp_path / "in", tmp_path / "at"
    path.mkdir()

    def more(name, text):
        with open(path / name, "ab") as f:
            f.write(text)

    def step():
        return sorted(r[1:] for r in run(tail.followed(spark, str(path)), "tail", at, "append"))

    more("a.jsonl", b"one\ntwo\r\nthr")
    assert step() == [(0, "one"), (4, "two")]
    assert step() == []
    more("a.jsonl", b"ee\n\nf\xc3\xbcnf\n")
    more("b.jsonl", b"other, without an end")
    more(".hidden", b"no\n")
    assert step() == [(9, "three"), (15, ""), (16, "fünf")]
    more("b.jsonl", b"\n" + b"x" * 100 + b"\n")
    assert step() == [(0, "other, without an end"), (22, "x" * 100)]
    assert step() == []


def test_spans_part_a_file_by_lines(tmp_path, monkeypatch):
    monkeypatch.setattr(tail, "SPLIT", 10)
    text = b"".join(b"%d\n" % 7**i for i in range(40)) + b"torn"
    (tmp_path / "f").write_bytes(text)
    reader = tail._Reader(str(tmp_path), 1 << 20)
    end = reader.latestOffset()
    assert list(json.loads(end["files"]).values()) == [len(text) - 4]
    spans = reader.partitions(reader.initialOffset(), end)
    got = [v for s in spans for b in reader.read(s) for v in b.column(2).to_pylist()]
    assert len(spans) > 5 and got == [str(7**i) for i in range(40)]
    short = tail._Reader(str(tmp_path), 12)
    seen, before = [], short.initialOffset()
    for _ in range(200):
        now = short.latestOffset()
        seen += [v for s in short.partitions(before, now) for b in short.read(s) for v in b.column(2).to_pylist()]
        before = now
    assert seen == got


EVENTS = [
    {"v": 1, "seq": 1, "kind": "book_state", "book_id": "b", "payload": {"state": "active", "title": "T"}},
    {"v": 1, "seq": 2, "kind": "stage_state", "book_id": "b", "stage": "identity", "payload": {"state": "active"}},
    {"v": 1, "seq": 3, "kind": "stage_state", "book_id": "b", "payload": {"stage": "unheard", "state": "active"}},
    {"v": 2, "seq": 4, "kind": "book_state", "book_id": "b", "payload": {"state": "failed"}},
    {"v": 1, "seq": 5, "kind": "candidate_upsert", "book_id": "b", "payload": {"table": "relationships", "key": "k", "record": {"from": "A", "note": "old"}}},
    {"v": 1, "seq": 6, "kind": "verdict_upsert", "book_id": "b", "payload": {"row_key": "k", "decision": "keep", "p": 0.7, "record": {"final_state": "validated", "note": "new"}}},
    {"v": 1, "seq": 7, "kind": "chapter_state", "book_id": "b", "payload": {"pass_id": "identity", "index": 3, "text": "t"}},
    {"v": 1, "seq": 8, "kind": "chapter_state", "book_id": "b", "payload": {"pass_id": "identity", "index": 3, "names": ["A"]}},
    {"v": 1, "seq": 9, "kind": "verdict_upsert", "book_id": "b", "payload": {"row_key": "k", "final_state": "no such"}},
    {"v": 1, "seq": 10, "kind": "counts_snapshot", "book_id": "b", "payload": {"counts": {"x": 1, "y": 2}}},
    {"v": 1, "seq": 11, "kind": "candidate_upsert", "book_id": "b", "payload": {"table": "tropes", "key": "q", "record": {"not_selected": True}}},
    {"v": 1, "seq": 12, "kind": "verdict_upsert", "book_id": "b", "payload": {"table": "tropes", "row_key": "q", "decision": "keep", "final_state": "validated"}},
    {"v": 1, "seq": 13, "kind": "counts_snapshot", "book_id": "b", "payload": {"counts": {"y": 5}}},
    {"v": 1, "seq": 14, "kind": "unknown", "book_id": "b", "payload": {}},
    {"v": 1, "seq": 15, "kind": "candidate_upsert", "book_id": "b", "payload": {"table": "no table", "key": "z"}},
    {"v": 1, "seq": 16, "kind": "candidate_upsert", "book_id": "b", "payload": {"table": "relationships", "key": "again", "record": {"old": 1}}},
    {"v": 1, "seq": 17, "kind": "verdict_upsert", "book_id": "b", "payload": {"row_key": "again", "decision": "drop", "final_state": "rejected"}},
    {"v": 1, "seq": 18, "kind": "candidate_upsert", "book_id": "b", "payload": {"table": "relationships", "key": "again", "record": {"new": 2}}},
    {"v": 1, "seq": 19, "kind": "run_state", "payload": {"state": "complete"}},
    {"v": 1, "seq": 20, "kind": "book_final", "book_id": "b", "payload": {}},
]


def as_lines(events):
    return [json.dumps({**e, "run_id": "r", "payload": json.dumps(e["payload"])}) for e in events]


def test_console_reduces_a_stream_as_it_does_a_table(spark, tmp_path, rocks):
    table = console.newest(console.facts(jsonlines.parsed(spark.createDataFrame([(x,) for x in as_lines(EVENTS)], "value string"), console.EVENT)))
    want = {(r.section, r.item, r.field): r.value for r in table.collect()}
    assert want == {
        ("book", "", "state"): "complete",
        ("book", "", "title"): "T",
        ("stage", "identity", "state"): "active",
        ("row", "relationships/k", "table"): "relationships",
        ("row", "relationships/k", "from"): "A",
        ("row", "relationships/k", "note"): "new",
        ("row", "relationships/k", "decision"): "keep",
        ("row", "relationships/k", "p"): "0.7",
        ("row", "relationships/again", "table"): "relationships",
        ("row", "relationships/again", "new"): "2",
        ("row", "tropes/q", "table"): "tropes",
        ("row", "tropes/q", "not_selected"): "true",
        ("row", "tropes/q", "decision"): "keep",
        ("row", "tropes/q", "final_state"): "validated",
        ("chapter", "identity/3", "pass_id"): "identity",
        ("chapter", "identity/3", "index"): "3",
        ("chapter", "identity/3", "text"): "t",
        ("chapter", "identity/3", "names"): '["A"]',
        ("count", "", "x"): "1",
        ("count", "", "y"): "5",
    }
    shown = {r.item: (r.decision, r.p, r.final_state) for r in console.display_rows(table).collect()}
    assert shown == {"relationships/k": ("keep", 0.7, None), "relationships/again": (None, None, None), "tropes/q": (None, None, None)}
    assert {(r.table, r.n, r.capped) for r in console.row_counts(table).collect()} == {("relationships", 2, False), ("tropes", 1, False)}
    path = tmp_path / "in"
    path.mkdir()
    kept = {}
    for i, part in enumerate((EVENTS[:6], EVENTS[6:13], EVENTS[13:])):  # restarted between the parts
        with open(path / "run.jsonl", "a") as f:
            f.write("".join(x + "\n" for x in as_lines(part)))
        events = jsonlines.parsed(tail.followed(spark, str(path)).select("value"), console.EVENT)
        for r in run(console.followed(console.facts(events)), f"facts{i}", tmp_path / "at"):
            kept[r[2:5]] = (r[5], r[6])
    # what an item lost by starting anew is older than what it was last said to be
    began = {("row", f"relationships/{k}"): s for k, s in (("k", 5), ("again", 18))} | {("row", "tropes/q"): 11}
    assert {k: v for k, (v, seq) in kept.items() if seq >= began.get(k[:2], 0)} == want


RUN = [
    ("book_start", "B", None, None, None, None),
    ("pair", None, "x", "y", 0.4, None),
    ("pair", None, "y", "x", 0.6, None),
    ("verdict", None, "x", "y", None, "yes"),
    ("pair", None, "x", "y", 0.9, None),
    ("verdict", None, "x", "y", 0.1, "no"),
    ("pair", "C", "p", None, 0.5, None),
    ("verdict", "C", "p", "q", 0.5, "no"),
    ("book_start", "D", None, None, None, None),
    ("pair", None, "a", "a", 0.2, None),
    ("pair", None, "a", "a", None, None),
    ("pair", None, "b", "a", 0.3, None),
]


def test_matrix_of_a_stream_is_that_of_the_table(spark, tmp_path, rocks):
    rows = [("r", i, *e, "judge" if e[0] == "verdict" else None, None) for i, e in enumerate(RUN)] + [("s", 0, "pair", None, "x", "y", 1.0, None, None, None)]
    table = spark.createDataFrame(rows, console.RUN_EVENT)
    want = sorted(map(tuple, console.matrix(table).collect()))
    assert want == [
        ("r", "B", "x", "y", 0.6, "settled", "yes", "judge", None, 3),
        ("r", "C", "p", "q", 0.5, "settled", "no", "judge", None, 7),
        ("r", "D", "a", "a", None, "scored", None, None, None, 10),
        ("r", "D", "a", "b", 0.3, "scored", None, None, None, 11),
    ]
    assert sorted(map(tuple, console.matrix_names(table).collect())) == [("r", "B", "x", 0), ("r", "B", "y", 1), ("r", "C", "p", 0), ("r", "C", "q", 1), ("r", "D", "a", 0), ("r", "D", "b", 1)]
    first, second = str(tmp_path / "in"), str(tmp_path / "mid")
    cells = {}
    for i, (a, b) in enumerate(((0, 5), (5, 9), (9, 13))):
        spark.createDataFrame(rows[a:b], console.RUN_EVENT).coalesce(1).write.mode("append").json(first)
        inside = console.live_brackets(spark.readStream.schema(console.RUN_EVENT).json(first))
        q = inside.writeStream.format("json").option("path", second).option("checkpointLocation", str(tmp_path / "at1")).outputMode("append").start()
        q.processAllAvailable()
        q.stop()
        stream = console.live_cells(spark.readStream.schema(console.RUN_EVENT).json(second))
        for r in run(stream, f"cells{i}", tmp_path / "at2"):
            cells[r[:4]] = r
    assert sorted(cells.values()) == want


def test_silence_interrupts_and_speech_revives(spark, tmp_path, rocks):
    base = 1_700_000_000
    events = [("r", 1, "pair", 0), ("r", 2, "pair", 100), ("q", 1, "pair", 120), ("q", 2, "run_end", 130), ("r", 3, "pair", 9000), ("r", 4, "run_end", 9010), ("r", 5, "pair", 9020), ("z", 1, "pair", 20000)]
    rows = [(r, s, e, base + t) for r, s, e, t in events]
    table = spark.createDataFrame(rows, "run_id string, seq long, event string, t long").withColumn("ts", F.timestamp_seconds("t")).drop("t")
    want = {("r", "running", base * 1000), ("r", "interrupted", (base + 1900) * 1000), ("r", "running", (base + 9000) * 1000), ("r", "finished", (base + 9010) * 1000), ("q", "running", (base + 120) * 1000), ("q", "finished", (base + 130) * 1000), ("z", "running", (base + 20000) * 1000)}
    assert {tuple(r) for r in console.run_states(table).collect()} == want
    path, got = str(tmp_path / "in"), []
    for i, n in enumerate(([0, 1, 2, 3], [4, 5], [6, 7])):
        spark.createDataFrame([rows[j] for j in n], "run_id string, seq long, event string, t long").withColumn("ts", F.timestamp_seconds("t")).drop("t").coalesce(1).write.mode("append").json(path)
        stream = console.live_states(spark.readStream.schema("run_id string, seq long, event string, ts timestamp").json(path))
        got += run(stream, f"states{i}", tmp_path / "at")
    assert set(got) == want
