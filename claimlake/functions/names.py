"""Keys and forms of names, titles and identifiers, as Column expressions. A null name counts as an empty one unless said otherwise."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accented() -> tuple[str, str]:
    """Letters of the Latin blocks whose compatibility decomposition is one letter and marks, and those letters."""
    some = [(chr(c), [x for x in unicodedata.normalize("NFKD", chr(c)) if not unicodedata.combining(x)]) for c in (*range(0xAA, 0x250), *range(0x1E00, 0x1F00))]
    pairs = [(a, b[0]) for a, b in some if len(b) == 1 and b[0] != a]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _accented()
#: Leading ranks and forms of address.
TITLES = ("agent", "special", "detective", "sergeant", "major", "colonel", "general", "captain", "lieutenant", "doctor", "dr", "mr", "mrs", "ms", "sir", "officer", "chief", "deputy", "inspector", "herr", "oberstleutnant", "oberst", "ss")
FAMILY = ("spouse", "parent", "child", "sibling")


def let(value: Column, body) -> Column:
    """body(value), the value told once however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _text(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def _tidy(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def unaccented(c: Column | str) -> Column:
    """Latin letters without their marks; combining marks go."""
    return F.regexp_replace(F.translate(_text(c), ACCENTED, PLAIN), "[̀-ͯ]", "")


def norm(c: Column | str) -> Column:
    """Lower case without marks; runs of anything but letters and digits become one space."""
    return F.trim(F.regexp_replace(F.lower(unaccented(c)), r"(?U)[\W_]+", " "))


def norm_name(c: Column | str) -> Column:
    """Lower case, without one leading article, tidy spaces."""
    return _tidy(F.regexp_replace(F.lower(_tidy(_text(c))), r"^(the|a|an)\s+", ""))


def tidy_title(c: Column | str) -> Column:
    """Lower case, underscores as spaces, tidy spaces; accents and punctuation stay."""
    return _tidy(F.replace(F.lower(_text(c)), F.lit("_"), F.lit(" ")))


def name_key(c: Column | str) -> Column:
    """Lower case without marks; runs of anything but a-z and 0-9 become one space."""
    return F.trim(F.regexp_replace(unaccented(F.lower(_text(c))), "[^a-z0-9]+", " "))


def work_key(c: Column | str) -> Column:
    """name_key without one leading article "the"."""
    return F.regexp_replace(name_key(c), "^the ", "")


def fixture_key(c: Column | str) -> Column:
    """Lower case; runs of anything but a-z and 0-9, accented letters too, become one space."""
    return F.trim(F.regexp_replace(F.lower(_text(c)), "[^a-z0-9]+", " "))


def slug(c: Column | str) -> Column:
    """A key for folders; unknown-book where nothing is left."""
    s = F.regexp_replace(F.regexp_replace(F.lower(_text(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(s == "", "unknown-book").otherwise(s)


def name_tokens(c: Column | str) -> Column:
    """Words of a name, without parentheses and leading titles."""
    low = F.regexp_replace(F.lower(_text(c)), r"\s*\([^)]*\)", "")
    words = F.array_join(F.regexp_extract_all(low, F.lit("[a-z0-9']+"), F.lit(0)), " ")
    bare = F.regexp_replace(words, rf"^(?:(?:{'|'.join(TITLES)})(?: |$))+", "")
    return F.filter(F.split(bare, " "), lambda t: t != "")


def surname(c: Column | str) -> Column:
    """What stands before a comma, or the last word: a-z and 0-9 alone."""
    n = F.trim(_text(c))
    head = F.when(F.contains(n, F.lit(",")), F.substring_index(n, ",", 1)).otherwise(F.element_at(F.split(n, r"\s+"), -1))
    return F.regexp_replace(F.lower(head), "[^a-z0-9]", "")


def titles_match(candidate: Column | str, local: Column | str) -> Column:
    """Tidy titles agree, but for a series prefix in brackets on the local one; a candidate of over 3 signs may also stand inside the local one."""
    a, b = tidy_title(candidate), tidy_title(local)
    bare = F.trim(F.regexp_replace(b, r"^\[.*?\]\s*[-–:]\s*", ""))
    return (a != "") & (b != "") & ((a == b) | (a == bare) | ((F.length(a) > 3) & F.contains(b, a)))


def prefix_related(a: Column, b: Column) -> Column:
    """One normalised name consists of the other's first words; equal and empty names do not count."""
    longer, shorter = F.when(F.length(a) > F.length(b), a).otherwise(b), F.when(F.length(a) > F.length(b), b).otherwise(a)
    return (a != "") & (b != "") & (a != b) & F.startswith(longer, F.concat(shorter, F.lit(" ")))


def pair_key(a: Column, b: Column) -> Column:
    """Two names in order, as one key."""
    return F.concat_ws("|", F.least(a, b), F.greatest(a, b))


def canonical_pair(a: Column, b: Column, kind: Column) -> Column:
    """(source, target, kind) in alphabetical order without regard to case; parent and child change places with their ends, mentor keeps its direction, a name with itself gives null."""
    flip = (F.lower(a) > F.lower(b)) & (kind != "mentor")
    turned = F.when(kind == "parent", "child").when(kind == "child", "parent").otherwise(kind)
    out = F.struct(F.when(flip, b).otherwise(a).alias("source"), F.when(flip, a).otherwise(b).alias("target"), F.when(flip, turned).otherwise(kind).alias("kind"))
    return F.when(F.lower(a) != F.lower(b), out)


def same_person(a: Column, b: Column) -> Column:
    """yes, no or ambiguous for two arrays of name_tokens: a common last word under other first words says no; equal names and runs of two words or more of the longer name say yes."""
    last = F.element_at(a, -1) == F.element_at(b, -1)
    no = (F.size(a) >= 2) & (F.size(b) >= 2) & (F.get(a, F.lit(0)) != F.get(b, F.lit(0))) & last
    x, y = (F.concat(F.lit(" "), F.array_join(t, " "), F.lit(" ")) for t in (a, b))
    inside = (F.least(F.size(a), F.size(b)) >= 2) & (F.contains(x, y) | F.contains(y, x))
    some = (F.size(a) > 0) & (F.size(b) > 0)
    return F.when(some & no, "no").when(some & ((x == y) | inside), "yes").otherwise("ambiguous")


def overlap_score(a: Column, b: Column) -> Column:
    """0.9 if two names share a word, 0.1 if not."""
    return F.when(F.arrays_overlap(F.split(F.lower(a), r"\s+"), F.split(F.lower(b), r"\s+")), 0.9).otherwise(0.1)


def form_class(form: Column, full: Column) -> Column:
    """How a form stands to a full name: full, first, surname or nickname."""
    words = F.split(full, " ")
    return F.when(form == full, "full").when(form == F.get(words, F.lit(0)), "first").when(form == F.element_at(words, -1), "surname").otherwise("nickname")


def _digit(s: Column, i: int) -> Column:
    return F.substring(s, i + 1, 1).cast("int")


def valid_isbn(c: Column | str) -> Column:
    """The signs of a valid ISBN-10 or ISBN-13 without marks, or null."""

    def checked(s: Column) -> Column:
        thirteen = sum(_digit(s, i) * (3 if i % 2 else 1) for i in range(13)) % 10 == 0
        last = F.when(F.right(s, F.lit(1)) == "X", 10).otherwise(F.try_to_number(F.right(s, F.lit(1)), F.lit("9")).cast("int"))
        ten = (sum(_digit(s, i) * (10 - i) for i in range(9)) + last) % 11 == 0
        return F.when(s.rlike("^[0-9]{13}$"), F.when(thirteen, s)).when(s.rlike("^[0-9]{9}[0-9X]$"), F.when(ten, s))

    return let(F.upper(F.regexp_replace(F.regexp_replace(F.trim(_text(c)), "(?i)^urn:isbn:", ""), r"[\s-]", "")), checked)


def isbn13(c: Column | str) -> Column:
    """The 13-digit form of a valid ISBN of either length, or null."""

    def longer(s: Column) -> Column:
        core = F.concat(F.lit("978"), F.left(s, F.lit(9)))
        check = (10 - sum(_digit(core, i) * (3 if i % 2 else 1) for i in range(12)) % 10) % 10
        return F.when(F.length(s) == 13, s).when(F.length(s) == 10, F.concat(core, check.cast("string")))

    return let(valid_isbn(c), longer)


def series_of_file(c: Column | str) -> Column:
    """(series, number) that a file name carries: [Series 02] - or (Series #2.5); null without."""
    s = _text(c)
    square, round_ = r"^\[(.+?)\s+([0-9]+(?:\.[0-9]+)?)\]\s*-", r"\(([^()#]+?),?\s*#([0-9]+(?:\.[0-9]+)?)\)"
    found = [F.struct(F.regexp_extract(s, p, 1).alias("series"), F.regexp_extract(s, p, 2).cast("double").alias("number")) for p in (square, round_)]
    return F.when(s.rlike(square), found[0]).when(s.rlike(round_), found[1])


def series_label(series: Column, number: Column) -> Column:
    """Series #2; whole numbers without a point, no number: the series alone."""
    shown = F.when(number == F.floor(number), number.cast("long").cast("string")).otherwise(number.cast("string"))
    return F.when(number.isNull(), series).otherwise(F.concat(series, F.lit(" #"), shown))


def run_process(c: Column | str) -> Column:
    """The process number in run-<date>-<time>-<number>[-n].jsonl, or null."""
    return F.nullif(F.regexp_extract(_text(c), r"^run-[0-9]+-[0-9]+-([0-9]+)(?:-[0-9]+)?\.jsonl$", 1), F.lit("")).cast("long")


#: Words that name a relation or a rank, not a person.
KIN = ("wife", "husband", "son", "daughter", "mother", "father", "mom", "dad", "brother", "sister", "uncle", "aunt", "cousin", "nephew", "niece", "grandmother", "grandfather", "grandson", "granddaughter", "parent", "parents", "child", "children", "fiance", "fiancee", "girlfriend", "boyfriend", "widow", "widower")


def valid_alias(c: Column | str) -> Column:
    """Whether a form may stand for a person: no possessive, no word of kinship alone, no form of address with a surname (Mrs. X is another person than X), and not "the" before a description."""
    low = F.lower(_tidy(F.replace(_text(c), F.lit("’"), F.lit("'"))))
    bare = F.regexp_replace(low, "[^a-z ]", "")
    return (low != "") & ~low.rlike(r"'s\b|s'(\s|$)") & ~bare.isin(*KIN) & ~low.rlike(r"^(mr|mrs|ms|miss)\b\.?") & ~low.rlike(r"^(the|a|an|my|his|her|their|our)\s")


def chapter_order(c: Column | str) -> Column:
    """A key that sorts whole numbers first, by size, and other labels after them, by their text."""
    s = F.trim(_text(c))
    number = F.when(s.rlike("^[+-]?[0-9]{1,18}$"), s.cast("long"))
    return F.struct(number.isNull().cast("int").alias("other"), F.coalesce(number, F.lit(0).cast("long")).alias("number"), F.when(number.isNull(), s).otherwise("").alias("text"))
