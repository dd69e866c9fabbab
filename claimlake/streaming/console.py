"""Live runs: what console events say of each book, and the grid of judged pairs; the same facts over a table and over a stream.

Events become facts first, row by row. A table keeps the newest fact of each field by aggregation; a stream keeps them
in state that is keyed by what the fact is about, so a busy run is spread over its items.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.joins import nearest_before
from ..operators.reduce import frozen

#: The version of the event contract, its kinds, the stages of a book, the tables of rows and how many rows of each a display keeps, and the states that end a relationship.
VERSION = 1
KINDS = ("run_state", "book_state", "stage_state", "chapter_state", "candidate_upsert", "verdict_upsert", "counts_snapshot", "log", "book_final")
STAGES = ("acquisition", "identity", "content", "merge_review", "relationship_validation", "content_gates", "evidence_retrieval", "final_gates")
ROW_CAPS = {"characters": 1000, "relationships": 2000, "tropes": 500, "triggers": 100, "merges": 1000}
FINAL_STATES = ("validated", "rejected", "review_required", "budget_exhausted", "validator_error")

EVENT = "v int, seq long, ts double, run_id string, book_id string, stage string, kind string, payload string"
FACT = "array<struct<section: string, item: string, field: string, value: string, fresh: boolean>>"
ITEM = ["run_id", "book_id", "section", "item"]
KEPT = "run_id string, book_id string, section string, item string, field string, value string, seq long"


def _said(path: str) -> Column:
    return F.get_json_object("payload", f"$.{path}")


def _fact(section: str, item: Column, field: Column, value: Column, fresh: bool = False) -> Column:
    return F.struct(F.lit(section).alias("section"), item.cast("string").alias("item"), field.cast("string").alias("field"), value.cast("string").alias("value"), F.lit(fresh).alias("fresh"))


def _fields(section: str, item: Column, json: Column, without: tuple[str, ...] = ()) -> Column:
    """A fact for each field of a JSON object."""
    pairs = F.map_entries(F.from_json(F.coalesce(json, F.lit("{}")), "map<string, string>"))
    kept = F.filter(F.coalesce(pairs, F.array().cast("array<struct<key: string, value: string>>")), lambda e: ~e["key"].isin(*without) if without else F.lit(True))
    return F.transform(kept, lambda e: _fact(section, item, e["key"], e["value"]))


def facts(events: DataFrame) -> DataFrame:
    """run_id, book_id, section, item, field, value, seq, fresh: what each event (schema EVENT, payload as JSON text) says.

    Events of another version, of unknown kinds or without a book say nothing; nor do unknown stages and tables. fresh:
    the item starts anew, and what was said of it before no longer counts. decision, p and final_state come from a
    verdict's top level alone, final_state only as one of FINAL_STATES. Missing fields say nothing.
    """
    none = F.array().cast(FACT)
    stage = F.coalesce("stage", _said("stage"))
    table = F.coalesce(_said("table"), F.when(F.col("kind") == "verdict_upsert", "relationships"))
    row = F.concat_ws("/", table, F.coalesce(_said("row_key"), _said("key")))
    known = table.isin(*ROW_CAPS) & F.when(F.col("kind") == "verdict_upsert", _said("row_key")).otherwise(_said("key")).isNotNull()
    chapter = F.concat_ws("/", F.coalesce(_said("pass_id"), F.lit("")), F.coalesce(_said("index"), F.lit("")))
    final = _said("final_state")

    def some(f: Column) -> Column:
        return F.filter(F.array(f), lambda x: x["value"].isNotNull())

    said = (
        F.when(F.col("kind") == "book_state", F.concat(some(_fact("book", F.lit(""), F.lit("state"), _said("state"))), some(_fact("book", F.lit(""), F.lit("title"), F.nullif(_said("title"), F.lit(""))))))
        .when(F.col("kind") == "stage_state", F.when(stage.isin(*STAGES), some(_fact("stage", stage, F.lit("state"), F.nullif(_said("state"), F.lit(""))))))
        .when(F.col("kind") == "chapter_state", _fields("chapter", chapter, F.col("payload")))
        .when(F.col("kind") == "candidate_upsert", F.when(known, F.concat(F.array(_fact("row", row, F.lit("table"), table, fresh=True)), _fields("row", row, _said("record")))))
        .when(
            F.col("kind") == "verdict_upsert",
            F.when(
                known,
                F.concat(
                    F.array(_fact("row", row, F.lit("table"), table)),
                    _fields("row", row, _said("record"), without=("decision", "final_state")),
                    some(_fact("row", row, F.lit("decision"), _said("decision"))),
                    some(_fact("row", row, F.lit("p"), _said("p"))),
                    F.when(final.isin(*FINAL_STATES), F.array(_fact("row", row, F.lit("final_state"), final))).otherwise(none),
                ),
            ),
        )
        .when(F.col("kind") == "counts_snapshot", _fields("count", F.lit(""), _said("counts")))
        .when(F.col("kind") == "book_final", F.array(_fact("book", F.lit(""), F.lit("state"), F.lit("complete"))))
    )
    own = events.filter((F.col("v") == VERSION) & F.col("kind").isin(*KINDS) & F.col("book_id").isNotNull())
    return own.select("run_id", "book_id", F.coalesce("seq", F.lit(0)).cast("long").alias("seq"), F.explode(F.coalesce(said, none)).alias("f")).select("run_id", "book_id", "f.section", "f.item", "f.field", "f.value", "seq", "f.fresh")


def newest(said: DataFrame) -> DataFrame:
    """The newest fact of each field of a table's facts(), counted from where its item last started anew."""
    began = said.filter("fresh").groupBy(*(F.col(k).alias(f"__{k}") for k in ITEM)).agg(F.max("seq").alias("__began"))
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in ITEM))
    live = said.join(began, same, "left").filter(F.col("__began").isNull() | (F.col("seq") >= F.col("__began")))
    # of one event's facts of a field the largest counts: an event says a field once
    return live.groupBy(*ITEM, "field").agg(F.max_by("value", F.struct("seq", "value")).alias("value"), F.max("seq").alias("seq"))


class _Newest(StatefulProcessor):
    """Facts of one item: what each field was last said to be, and since when the item counts."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.fields = handle.getMapState("fields", "field string", "value string, seq long")
        self.began = handle.getValueState("began", "seq long")

    def handleInputRows(self, key, rows, timerValues):
        said = pd.concat(list(rows)).sort_values("seq", kind="stable")
        began = self.began.get()[0] if self.began.exists() else -1
        if (latest := said.loc[said["fresh"], "seq"].max()) >= began and latest == latest:
            began = int(latest)
            self.began.update((began,))
            for (field,) in list(self.fields.keys()):
                if self.fields.getValue((field,))[1] < began:
                    self.fields.removeKey((field,))
        out = {}
        for field, value, seq in said.loc[said["seq"] >= began, ["field", "value", "seq"]].itertuples(index=False):
            before = self.fields.getValue((field,)) if self.fields.containsKey((field,)) else None
            if before is None or (seq, value) >= (before[1], before[0]):
                self.fields.updateValue((field,), (value, int(seq)))
                out[field] = (value, int(seq))
        if out:
            yield pd.DataFrame([(*key, f, v, s) for f, (v, s) in out.items()], columns=[*ITEM, "field", "value", "seq"])

    def close(self) -> None:
        pass


def followed(said: DataFrame) -> DataFrame:
    """newest() over a stream of facts(): each field again whenever it changes. Needs the RocksDB state store."""
    keyed = said.withColumns({k: F.coalesce(k, F.lit("")) for k in ITEM})
    return keyed.groupBy(*ITEM).transformWithStateInPandas(_Newest(), KEPT, "Update", "None")


def display_rows(kept: DataFrame) -> DataFrame:
    """run_id, book_id, item, table, decision, p, final_state of each row; a row that was not selected has neither decision nor final state."""
    wide = kept.filter("section = 'row'").groupBy("run_id", "book_id", "item").agg(*(F.max(F.when(F.col("field") == c, F.col("value"))).alias(c) for c in ("table", "decision", "p", "final_state", "not_selected")))
    shown = ~F.coalesce(F.col("not_selected") == "true", F.lit(False))
    return wide.select("run_id", "book_id", "item", "table", F.when(shown, F.col("decision")).alias("decision"), F.col("p").cast("double").alias("p"), F.when(shown, F.col("final_state")).alias("final_state"))


def row_counts(kept: DataFrame) -> DataFrame:
    """run_id, book_id, table, n and capped: rows of each table, all counted, and whether a display would not keep them all."""
    caps = F.create_map(*(F.lit(x) for pair in ROW_CAPS.items() for x in pair))
    rows = kept.filter("section = 'row' AND field = 'table'").groupBy("run_id", "book_id", F.col("value").alias("table")).agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumn("capped", F.col("n") > caps[F.col("table")])


RUN_EVENT = "run_id string, seq long, event string, book string, a string, b string, score double, verdict string, via string, reason string"


def in_books(events: DataFrame) -> DataFrame:
    """Events of runs (RUN_EVENT), those without a book under the book whose bracket they stand in."""
    starts = events.filter("event = 'book_start'").select("run_id", "seq", F.struct("book").alias("bracket"))
    inside = nearest_before(events, starts, "run_id", "seq", "bracket")
    own = F.when(F.col("event") == "book_start", F.col("book")).otherwise(F.coalesce("book", F.col("before_bracket")["book"]))
    return inside.withColumn("book", own).drop("before_bracket")


def matrix(events: DataFrame) -> DataFrame:
    """run_id, book, a, b, score, state, verdict, via, reason, seq: a cell for each pair of names of a book.

    events: RUN_EVENT, seq rising within a run. A pair event scores a cell, a verdict settles it: the first verdict is
    final, and nothing later changes the cell. Events without both names, or outside any book, make no cell.
    """
    pairs = in_books(events).filter("event IN ('pair', 'verdict') AND a IS NOT NULL AND b IS NOT NULL AND book IS NOT NULL")
    pairs = pairs.withColumns({"a": F.least("a", "b"), "b": F.greatest("a", "b")})
    cell = ["run_id", "book", "a", "b"]
    ends = frozen(pairs, cell, "seq", F.col("event") == "verdict", "score")
    last = pairs.groupBy(*(F.col(k).alias(f"__{k}") for k in cell)).agg(F.min_by(F.struct("verdict", "via", "reason", "seq"), F.when(F.col("event") == "verdict", F.col("seq"))).alias("__settled"), F.max("seq").alias("__seq"))
    both = ends.join(last, reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in cell)))
    state = F.when(F.col("settled_at").isNotNull(), "settled").otherwise("scored")
    return both.select(*cell, F.col("last_value").alias("score"), state.alias("state"), "__settled.verdict", "__settled.via", "__settled.reason", F.coalesce("settled_at", "__seq").alias("seq"))


def matrix_names(events: DataFrame) -> DataFrame:
    """run_id, book, name, place: the names of a book's cells in order of first appearance, from 0."""
    pairs = in_books(events).filter("event IN ('pair', 'verdict') AND a IS NOT NULL AND b IS NOT NULL AND book IS NOT NULL")
    each = pairs.select("run_id", "book", "seq", F.posexplode(F.array("a", "b")).alias("end", "name")).groupBy("run_id", "book", "name").agg(F.min(F.struct("seq", "end")).alias("first"))
    return each.select("run_id", "book", "name", (F.row_number().over(Window.partitionBy("run_id", "book").orderBy("first")) - 1).alias("place"))


CELL = "run_id string, book string, a string, b string, score double, state string, verdict string, via string, reason string, seq long"


class _Cell(StatefulProcessor):
    """One cell of the grid: scored until its first verdict, then never changed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cell = handle.getValueState("cell", "score double, state string, verdict string, via string, reason string, seq long")

    def handleInputRows(self, key, rows, timerValues):
        cell = self.cell.get() if self.cell.exists() else None
        if cell is not None and cell[1] == "settled":
            return
        for event, score, verdict, via, reason, seq in pd.concat(list(rows)).sort_values("seq")[["event", "score", "verdict", "via", "reason", "seq"]].itertuples(index=False):
            score = None if score != score else score
            if event == "verdict":
                cell = (score if score is not None else cell and cell[0], "settled", verdict, via, reason, int(seq))
                break
            cell = (score, "scored", None, None, None, int(seq))
        self.cell.update(cell)
        yield pd.DataFrame([(*key, *cell)], columns=[c.split()[0] for c in CELL.split(", ")])

    def close(self) -> None:
        pass


class _Bracket(StatefulProcessor):
    """A run's events under the book whose bracket they stand in; the state is one name."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.book = handle.getValueState("book", "book string")

    def handleInputRows(self, key, rows, timerValues):
        own = pd.concat(list(rows)).sort_values("seq").astype({"book": object})
        book, out = (self.book.get()[0] if self.book.exists() else None), []
        for event, said in own[["event", "book"]].itertuples(index=False):
            said = None if said != said else said
            if event == "book_start":
                book = said
            out.append(book if event == "book_start" or said is None else said)
        self.book.update((book,))
        own["book"] = out
        yield own[[c.split()[0] for c in RUN_EVENT.split(", ")]]

    def close(self) -> None:
        pass


def live_brackets(events: DataFrame) -> DataFrame:
    """in_books() over a stream that hands out a run's events in order."""
    return events.groupBy("run_id").transformWithStateInPandas(_Bracket(), RUN_EVENT, "Append", "None")


def live_cells(events: DataFrame) -> DataFrame:
    """matrix() over a stream of events in their books: each cell again whenever it changes. Needs the RocksDB state store."""
    pairs = events.filter("event IN ('pair', 'verdict') AND a IS NOT NULL AND b IS NOT NULL AND book IS NOT NULL").withColumns({"a": F.least("a", "b"), "b": F.greatest("a", "b")})
    return pairs.groupBy("run_id", "book", "a", "b").transformWithStateInPandas(_Cell(), CELL, "Update", "None")


class _Liveness(StatefulProcessor):
    """A run's state in event time: running, interrupted after a silence, running again when it speaks, finished at its end."""

    def __init__(self, silence_ms: int):
        self.silence = silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "state string, last long")

    def _timers(self) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)

    def handleInputRows(self, key, rows, timerValues):
        state, last = self.state.get() if self.state.exists() else (None, None)
        out = []
        own = pd.concat(list(rows)).sort_values(["ts", "seq"])
        for event, ts in own[["event", "ts"]].itertuples(index=False):
            at = int(ts.timestamp() * 1000)
            if state == "running" and at - last > self.silence:
                state = "interrupted"
                out.append((*key, state, last + self.silence))
            now = "finished" if event == "run_end" else "finished" if state == "finished" else "running"
            if now != state:
                state = now
                out.append((*key, state, at))
            last = max(at, last or at)
        self.state.update((state, last))
        self._timers()
        if state == "running":
            self.handle.registerTimer(last + self.silence)
        if out:
            yield pd.DataFrame(out, columns=["run_id", "state", "since_ms"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        state, last = self.state.get()
        if state == "running":
            self.state.update(("interrupted", last))
            yield pd.DataFrame([(*key, "interrupted", last + self.silence)], columns=["run_id", "state", "since_ms"])

    def close(self) -> None:
        pass


def live_states(events: DataFrame, silence: str = "1800 seconds", late: str = "1 minute") -> DataFrame:
    """run_id, state, since_ms over a stream (run_id, seq, event, ts timestamp): each change of a run's state; interrupted comes once the watermark has passed the silence, and a run that speaks again is running again."""
    ms = int(silence.split()[0]) * 1000
    return events.withWatermark("ts", late).groupBy("run_id").transformWithStateInPandas(_Liveness(ms), "run_id string, state string, since_ms long", "Update", "EventTime")


def run_states(events: DataFrame, silence: int = 1800) -> DataFrame:
    """run_id, state, since_ms of a table (run_id, seq, event, ts timestamp): every change of state, without the last silence, which only a clock can tell."""
    w = Window.partitionBy("run_id").orderBy("ts", "seq")
    ms = F.unix_millis("ts") if dict(events.dtypes)["ts"] == "timestamp" else F.unix_millis(F.col("ts").cast("timestamp"))
    x = events.select("run_id", "seq", "event", "ts", ms.alias("__ms")).withColumn("__last", F.lag("__ms").over(w)).withColumn("__over", F.count_if(F.col("event") == "run_end").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    silent = F.col("__ms") - F.col("__last") > silence * 1000
    ended = (F.col("event") == "run_end") & (F.col("__over") == 0)
    changes = F.array(
        F.when((F.col("__over") == 0) & silent, F.struct(F.lit("interrupted").alias("state"), (F.col("__last") + silence * 1000).alias("since_ms"))),
        F.when(ended, F.struct(F.lit("finished").alias("state"), F.col("__ms").alias("since_ms"))).when((F.col("__over") == 0) & (F.col("__last").isNull() | silent), F.struct(F.lit("running").alias("state"), F.col("__ms").alias("since_ms"))),
    )
    return x.select("run_id", F.explode(F.filter(changes, lambda c: c.isNotNull())).alias("c")).select("run_id", "c.*")
