"""Personal data by regular expressions, checksums and context words, on Spark SQL functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which spans with the same start are listed.
KINDS = ("email", "ip", "card", "phone", "iban", "secret", "local")
BASE = KINDS[:4]
_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"
#: Every quantifier that cannot need backtracking is possessive, and a match may begin only where a run begins or the match before it ended: linear time on very long runs, same matches.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_-]{16,}+",
    "local": r"(?<![0-9+])(?<!\+[0-9]{1,3} ?)\(?[0-9]{3}\)?[-. ][0-9]{3}[-. ][0-9]{4}(?![0-9-])",
}
#: How keys of well-known services begin.
ISSUED = r"^(?:A[KS]IA[A-Z0-9]{16}$|gh[opsu]_|sk-|xox[abprs]-)"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: What a kind's score is before the words near it are read, what these add and take away. Secrets that no known service issues and phone numbers without a plus count only where words speak for them.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "secret": 0.2, "local": 0.3}
FOR = {"secret": 0.4, "local": 0.3}
CONTEXT = {
    "email": "mail|contact|kontakt|correo|courriel|adress|write",
    "ip": r"\bip\b|host|server|address|login|client",
    "card": "card|visa|master|amex|credit|debit|karte|carte|tarjeta|pay",
    "phone": r"phone|\btel|\bcall|mobile|\bfax|anruf|appel|llam",
    "iban": "iban|bank|account|konto|compte|cuenta|transfer",
    "secret": r"password|passwort|passwd|\bpwd|secret|token|bearer|credential|api.?key|\bkey",
    "local": r"phone|\btel|\bcall|mobile|\bfax|anruf|appel|llam",
}
AGAINST = {"ip": "version|release|section", "card": r"\border\b|isbn|serial|tracking", "phone": r"isbn|serial|\border\b", "local": r"isbn|serial|\border\b"}
#: Characters before and after a span in which context words count, up to the next match of its kind; the score that a span needs.
NEAR, LEAST = 40, 0.5
#: Spans up to which redact() cuts the text by position.
FEW = 16


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total, i):
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 0, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _mod97(iban: Column) -> Column:
    s = F.translate(iban, " ", "")
    turned = F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, F.lit(1), F.lit(4)))

    def add(rest, c):
        code = F.ascii(c)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda rest, c: F.when(c == "", rest).otherwise(add(rest, c))) == 1


def _confirmed(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return m.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    n = F.length(_digits(m))
    if kind == "card":
        return F.when(n.between(14, 19), _luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return n.between(10, 15)
    if kind == "local":
        return F.lit(True)
    if kind == "secret":
        return m.rlike("[0-9]") & m.rlike("[A-Za-z]")
    return F.when(F.length(F.translate(m, " ", "")).between(15, 34), _mod97(m)).otherwise(False)


def _score(kind: str, m: Column, before: Column, after: Column) -> Column:
    """In tenths, so that sums are exact."""
    near = F.lower(F.concat(F.right(before, F.lit(NEAR)), F.lit("\n"), F.left(after, F.lit(NEAR))))
    base = F.lit(round(10 * SCORES[kind]))
    if kind == "secret":
        base = F.when(m.rlike(ISSUED), 9).otherwise(base)
    score = base + F.when(near.rlike(CONTEXT[kind]), round(10 * FOR.get(kind, 0.1))).otherwise(0)
    if kind in AGAINST:
        score = score - F.when(near.rlike(AGAINST[kind]), 3).otherwise(0)
    return F.least(F.lit(10), score) / 10


SPAN = "struct<kind: string, start: int, end: int, score: double>"
#: Steps of a fold that append to one array; longer folds append such arrays, so that the copying stays in proportion.
BLOCK = 128


def _folded(n: Column, step, kind: str, finish):
    """step(acc, i) for i from 0 to n - 1, where acc has at, an integer from 0, and items, an array of kind to append to; then finish(at, items). n: 1 or more."""
    empty = F.array().cast(f"array<{kind}>")

    def block(acc, b):
        own = F.sequence(b * BLOCK, F.least(b * BLOCK + BLOCK, n) - 1)
        inner = F.aggregate(own, F.struct(acc["at"].alias("at"), empty.alias("items")), step)
        return F.get(F.transform(F.array(inner), lambda r: F.struct(r["at"].alias("at"), F.concat(acc["items"], F.array(r["items"])).alias("items"))), F.lit(0))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{kind}>>").alias("items"))
    return F.aggregate(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")), zero, block, lambda acc: finish(acc["at"], F.flatten(acc["items"])))


def _spans(kind: str, found: Column, between: Column) -> Column:
    """Confirmed matches with their places: the text between matches and the matches add up to positions."""

    def step(acc, i):
        m, before = F.get(found, i), F.get(between, i)
        start = acc["at"] + F.length(before)
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(m)).alias("end"), _score(kind, m, before, F.get(between, i + 1)).alias("score"))
        return F.struct((start + F.length(m)).alias("at"), F.when(_confirmed(kind, m), F.concat(acc["items"], F.array(span))).otherwise(acc["items"]).alias("items"))

    return F.when(F.size(found) > 0, _folded(F.size(found), step, SPAN, lambda at, items: items)).otherwise(F.array().cast(f"array<{SPAN}>"))


def find(docs: DataFrame, least: float = LEAST, name: str = "pii", always: tuple[str, ...] = ()) -> DataFrame:
    """docs with a column name: an array of (kind, start, end, score) by start, then kind as listed; code points, end exclusive.

    Every kind's leftmost non-overlapping matches in the whole text; those that fail their checksum or length are
    dropped and not tried again. Words within NEAR characters on both sides, up to the next match of the kind, raise or
    lower a span's score; spans under least go, but for kinds in always. Null or empty text: an empty array. Other
    columns, nulls and repeated rows stay as they are; a column of that name is replaced. No rows: no rows. One pass, no
    shuffle, no Python.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    marks = {"email": "@", "phone": "+"}
    found = {k: F.regexp_extract_all(text, F.lit(p), F.lit(0)) for k, p in PATTERNS.items()}
    for k, mark in marks.items():
        found[k] = F.when(F.contains(text, F.lit(mark)), found[k]).otherwise(F.array().cast("array<string>"))
    out = docs.withColumns({f"__{k}": x for k, x in found.items()})
    out = out.withColumns({f"__{k}_between": F.when(F.size(f"__{k}") > 0, F.split(text, p, -1)) for k, p in PATTERNS.items()})
    out = out.withColumns({f"__{k}_spans": _spans(k, F.col(f"__{k}"), F.col(f"__{k}_between")) for k in KINDS})
    rank = F.map_from_arrays(F.array(*map(F.lit, KINDS)), F.array(*map(F.lit, range(len(KINDS)))))
    every = F.concat(*(F.col(f"__{k}_spans") for k in KINDS))
    keyed = F.transform(F.filter(every, lambda s: (s["score"] >= least) | s["kind"].isin(*always)), lambda s: F.struct(s["start"], rank[s["kind"]].alias("rank"), s["kind"], s["end"], s["score"]))
    pii = F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"], s["start"], s["end"], s["score"]))
    return out.withColumn(name, pii).drop(*(f"__{k}{x}" for k in KINDS for x in ("", "_between", "_spans")))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter(F.col("pii"), lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def digest(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, counts by base kind, SHA-256 of the base kinds' spans, all spans, their scores, and counts of the other kinds.

    Base spans stay whatever their score; spans of the other kinds need least. Rules as for find().
    """
    pii = F.col("pii")
    base = F.filter(pii, lambda s: s["kind"].isin(*BASE))
    return find(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), least, always=BASE).select(
        "doc_id",
        *(_count(k) for k in BASE),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(pii).alias("spans"),
        F.array_join(F.transform(pii, lambda s: s["score"].cast("string")), ",").alias("scores"),
        *(_count(k) for k in KINDS[len(BASE) :]),
    )


def redact(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """docs with each span of find() replaced by its kind in brackets; of overlapping spans the first stands for all.

    Null text stays null; all columns of docs stay, one named pii too. A text with over FEW spans is taken apart into
    its characters once, so the time is proportional to the text and not to text times spans.
    """
    cols, spans = docs.columns, F.col("__found")
    text = F.col("text")
    signs = F.split(text, "")

    def replaced(cut) -> Column:
        def step(acc, i):
            s = F.get(spans, i)
            mark = F.concat(cut(acc["at"], s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], F.concat(acc["items"], F.array(mark))).otherwise(acc["items"]).alias("items"))

        return _folded(F.size(spans), step, "string", lambda at, items: F.concat(F.array_join(items, ""), cut(at, F.greatest(F.lit(0), F.length(text) - at))))

    few = replaced(lambda at, n: F.substring(text, at + 1, n))
    many = replaced(lambda at, n: F.array_join(F.slice("__signs", at + 1, n), ""))
    found = find(docs, least, "__found").withColumn("__signs", F.when(F.size(spans) > FEW, signs))
    return found.withColumn("text", F.when(F.size(spans) > FEW, many).when(F.size(spans) > 0, few).otherwise(text)).select(*cols)
