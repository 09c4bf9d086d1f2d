"""Names and badge numbers in free text: normalisation, a dictionary of name forms, and their replacement by ids."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from operator import or_

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.io import stored

# Words that a name follows.
ROLES = (
    "Chief", "Deputy Chief", "DC", "Major", "Mjr", "Mgr", "Inspector", "Insp", "Commander", "Captain", "Cpt", "Cptn", "Lieutenant", "Ltn", "Sergeant",
    "Sgt", "Detective", "Det", "Corporal", "Corp", "Crp", "Police Officer", "Officer", "PO", "Ofcr", "Ofr", "Ofc", "Offc", "Offr", "IOfficer", "IOfc",
    "Patrol Officer", "Cadet", "R/O", "RO", "Trainee", "Agent", "Agnt", "ICE", "ICE Agent", "SA", "SAS", "Manager", "Technician", "Examiner",
    "Assistant", "DA", "District Attorney", "Volunteer", "Investigator", "CDPC", "Analyst", "Intern", "FBI Agent", "FBI", "Marshall",
    "Probation Officer", "ATF Agent", "ATF", "Reserve", "Attorney", "Contractor", "MCSO", "MCSD", "Medic", "Dispatcher",
)
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
BADGE_PATTERNS = (r"\([#0-9]*?\)", r"#[0-9-]+", r"code[0-9-]+", r"code no\.[0-9-]+", r"code number [0-9-]+", r"[0-9]{4,5}")
BADGE = "BADGENUM"
#: One of them. They match in one pass what they match one after the other: none that begins later overlaps one before it in this list.
ANY_BADGE = rf"(?=[(#c0-9])(?:{'|'.join(BADGE_PATTERNS)})"
#: White space that isn't one space already, and punctuation.
UNEVEN, MARKS = r"\s{2,}|[^\S ]", r"[!-/:-@\[-`{-~]+"
#: Words of the longest form of a name.
LONGEST = 3
#: Bits of the filter of forms: so many a form, and no more than these in all (64 MB), however many forms there are.
FORM_BITS, MOST_BITS = 12, 1 << 29
#: Bits of one of the bitmaps that Spark's bitmap functions build.
BITMAP = 1 << 15
#: A first and a last name with any initial between; GUESS stands for the initial that isn't known, as no name has punctuation.
WITH_INITIAL, GUESS = "^([^ ]+) [^ ] ([^ ]+)$", "?"


def normalize_report(text: Column) -> Column:
    """Lower case, white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), UNEVEN, " "))


def strip_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, MARKS, "")


def normalize_name(name: Column) -> Column:
    """As a report, without punctuation; null is empty."""
    return F.coalesce(strip_punctuation(normalize_report(name)), F.lit(""))


def scrub_badges(text: Column) -> Column:
    """Badge numbers become BADGENUM."""
    return F.regexp_replace(text, ANY_BADGE, BADGE)


def _every_form(names: DataFrame, order: str, short: bool) -> DataFrame:
    """order, pattern, id: the forms of `name_forms` of each person. short: GUESS stands for the 26 guessed initials between two names."""
    n = names.select(order, "id", *[normalize_name(F.col(c)).alias(c) for c in ("first", "middle", "last")])
    initial = lambda c: F.substring(c, 1, 1)
    has_first, has_middle = F.length("first") > 0, F.length("middle") > 0
    between = (F.trim("first") != "") & (F.trim("last") != "") if short else F.lit(False)
    form = lambda when, *parts: F.when(when, F.struct(F.concat(*parts).alias("pattern"), F.col("id").alias("id")))
    sure = [
        form(F.lit(True), F.col("last")),
        form(has_first & has_middle, initial("first"), initial("middle"), F.lit(" "), F.col("last")),
        form(has_first, F.col("first"), F.lit(" "), F.col("last")),
        form(has_first, initial("first"), F.lit(" "), F.col("last")),
        form(has_middle, F.col("first"), F.lit(" "), initial("middle"), F.lit(" "), F.col("last")),
    ]
    guess = lambda when, i: form(~has_middle & when, F.col("first"), F.lit(f" {i} "), F.col("last")).withField("id", F.concat("id", F.lit("?")))
    spelt = F.when(~has_middle & ~between, F.array(*[guess(F.lit(True), chr(97 + k)) for k in range(26)])).otherwise(F.array(*[guess(between, GUESS)] * short))
    every = n.select(order, F.explode(F.array_compact(F.concat(F.array(*sure), spelt))).alias("f"))
    return every.select(order, F.trim("f.pattern").alias("pattern"), "f.id").filter("pattern != ''")


def name_forms(names: DataFrame, order: str) -> DataFrame:
    """pattern, id: the forms of each person's name.

    names: `order`, id, first, middle, last. Forms: last; first initial and middle initial; first; first initial; first
    and middle initial. Without a middle name each of 26 initials is guessed, and the id ends in `?`. Of equal forms the
    one of the last person counts.
    """
    return _every_form(names, order, False).groupBy("pattern").agg(F.max_by("id", order).alias("id"))


def short_forms(names: DataFrame, order: str) -> DataFrame:
    """pattern, id, _order: `name_forms`, with one form in place of 26 that differ in the guessed initial alone. Of a run's own form and
    the one with GUESS that of the last person counts."""
    return _every_form(names, order, True).groupBy("pattern").agg(F.max_by("id", order).alias("id"), F.max(order).alias("_order"))


@dataclass(frozen=True)
class Roles:
    """Words that names follow: the last word of each role, the plurals of roles, and what a list after a plural may hold beside names."""

    ends: frozenset[str]
    plurals: frozenset[str]
    listed: frozenset[str]

    @classmethod
    def of(cls, roles: Sequence[str]) -> Roles:
        lower = [r.lower() for r in roles]
        return cls(frozenset(r.split()[-1] for r in lower), frozenset(f"{r}s" for r in lower), frozenset(["and", *lower]))

    def marks(self, words: Sequence[str]) -> list[int]:
        """Places of words that end a role or are a plural."""
        either = self.ends | self.plurals
        return [k for k, word in enumerate(words) if word in either]


def runs_at(words: Sequence[str], k: int) -> list[str]:
    """The runs of one to three words that begin at a word; an initial is joined to the name after it that way."""
    return [" ".join(words[k : k + n]) for n in range(1, min(LONGEST, len(words) - k) + 1)]


def after_roles(words: Sequence[str], roles: Roles, reach_at: Callable[[int], int]) -> list[int]:
    """Places where a name follows a role: one or two words after a singular (X5), and in the list of names, `and` and roles that
    begins with a plural (X6). reach_at: the end of the longest name that begins at a place, or the place itself."""
    places, closed = set(), 0
    for k in roles.marks(words):
        if words[k] in roles.ends:
            places.update(range(k + 1, min(k + 3, len(words))))
        if words[k] not in roles.plurals or k < closed:
            continue
        reach = reach_at(k - 1) if k else 0  # a name that begins before the plural may go on after it
        for closed in range(k, len(words)):  # noqa: B007
            reach = max(reach, reach_at(closed))
            if reach <= closed and words[closed] not in roles.listed and words[closed] not in roles.plurals:
                break
            places.add(closed)
    return sorted(places)


def asked_forms(words: Sequence[str], roles: Roles, maybe: Callable[[str], bool], ends: Mapping[str, bool] | None = None) -> set[str]:
    """All runs of words that must be looked up to replace a text's names: those after roles, and all that begin where one of these
    stands again. maybe: false only for runs that are no form of a name; ends: for words that end none."""
    seen: dict[int, list[str]] = {}
    last = [True] * len(words) if ends is None else list(map(ends.__getitem__, words))
    near = list(last)  # of most words none within reach ends a form
    for n in range(1, LONGEST):
        near = list(map(or_, near, [*last[n:], *[False] * n]))

    def at(k: int) -> list[str]:
        """Forms that may begin at a word, the longest one last."""
        if (found := seen.get(k)) is None:
            found = seen[k] = []
            for n, may in enumerate(last[k : k + LONGEST], k):
                if may and maybe(run := words[k] if n == k else " ".join(words[k : n + 1])):
                    found.append(run)
        return found

    places = after_roles(words, roles, lambda k: k + (found[-1].count(" ") + 1 if near[k] and (found := at(k)) else 0))
    known = {run for k in places if near[k] for run in at(k)}
    asked = known.union(*seen.values())
    first = {run.partition(" ")[0] for run in known}
    for k in [k for k, word in enumerate(words) if word in first]:
        if k not in seen and (words[k] in known or any(run in known for run in runs_at(words, k))):
            asked.update(at(k))
    return asked


def with_ids(words: Sequence[str], roles: Roles, ids: Mapping[str, str]) -> list[str]:
    """The words with names that follow a role somewhere in them replaced by ids, wherever they stand; the longest name that begins at a
    word counts, and of overlapping ones the first. ids holds what `asked_forms` asks for, as far as it is a form."""
    several = {run.partition(" ")[0] for run in ids if " " in run}
    names: dict[int, tuple[str, int]] = {}
    for k in [k for k, word in enumerate(words) if word in ids or word in several]:
        runs = reversed(runs_at(words, k)) if words[k] in several else words[k : k + 1]
        if run := next((run for run in runs if run in ids), None):
            names[k] = run, k + run.count(" ") + 1
    known = {names[k][0] for k in after_roles(words, roles, lambda k: names[k][1] if k in names else k) if k in names}
    out, done = [], 0
    for k, (run, end) in names.items():
        if run in known and k >= done:
            out += words[done:k]
            out.append(ids[run])
            done = end
    return out + list(words[done:])


def form_filter(forms: DataFrame) -> bytes:
    """A Bloom filter of the patterns of `name_forms` and of their last words, two bits for each, of MOST_BITS at most: where that is
    too few, more runs of words are looked up and the result is the same.

    Forms with an initial between two names are there without it, and forms of two initials and a name with the first alone: these are
    forms of the same name.
    """
    bits = 1 << min(MOST_BITS.bit_length() - 1, max(BITMAP, forms.count() * FORM_BITS).bit_length())
    plain = F.regexp_replace(F.regexp_replace("pattern", WITH_INITIAL, "$1 $2"), "^([^ ])[^ ] ([^ ]+)$", "$1 $2")
    codes = forms.select(F.explode(F.array(F.xxhash64(plain), F.xxhash64(F.concat(F.lit("* "), F.substring_index("pattern", " ", -1))))).alias("code")).distinct()
    spots = codes.select(F.explode(F.array(*[F.shiftrightunsigned("code", n).bitwiseAND(F.lit(bits - 1)) for n in (0, 32)])).alias("bit"))
    # each bitmap is made in one task, from bits that are shuffled as numbers
    maps = spots.withColumn("bucket", F.floor(F.col("bit") / BITMAP)).repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg((F.col("bit") % BITMAP).cast("long")).alias("bitmap"))
    out = bytearray(bits // 8)
    for bucket, bitmap in maps.collect():  # MOST_BITS / 8 bytes at most
        out[bucket * BITMAP // 8 : (bucket + 1) * BITMAP // 8] = bitmap
    return bytes(out)


class Remembered(dict):
    """What is found for a word, for some MOST words at a time."""

    MOST = 1 << 18

    def __init__(self, find: Callable[[str], bool]) -> None:
        self.find = find

    def __missing__(self, word: str) -> bool:
        if len(self) >= self.MOST:
            self.clear()
        found = self[word] = self.find(word)
        return found


class FormFilter:
    """Whether a run of words may be a form of a name; ends: whether a word may be the last one of a form."""

    def __init__(self, data: bytes) -> None:
        self.data, self.mask = data, len(data) * 8 - 1
        self.ends = Remembered(lambda word: self._has(f"* {word}"))
        self.words = Remembered(self._has)

    def _has(self, entry: str) -> bool:
        code = xxhash.xxh64_intdigest(entry.encode(), 42)
        a, b = code & self.mask, (code >> 32) & self.mask
        return bool(self.data[a >> 3] >> (a & 7) & 1 and self.data[b >> 3] >> (b & 7) & 1)

    def __call__(self, run: str) -> bool:
        front, _, last = run.rpartition(" ")
        if not self.ends[last]:
            return False
        if not front:
            return self.words[run]
        if len(front) > 2 and front[-2] == " " and front.count(" ") == 1:
            front = front[:-2]
        if len(front) == 2:
            front = front[0]
        return self._has(f"{front} {last}")


def anonymize(narratives: DataFrame, names: DataFrame, key: str, text: str, order: str, roles: Sequence[str] = ROLES) -> DataFrame:
    """key, text: badge numbers scrubbed, punctuation gone, names after roles replaced by their ids.

    A name found after a role is replaced wherever it stands in the same text (X5, X6); of overlapping names the one
    that begins first counts. Texts keep their words otherwise; null stays null, an empty text empty; rows may be repeated and
    have any key, null too.

    Texts are read where they lie: only runs of words within reach of a role, and where these stand again, are joined with the forms,
    those alone which the filter of forms passes. Texts are cleaned and read once, then stored with what they ask for; what is found
    comes back to its text by one join.
    """
    spark, words_of = narratives.sparkSession, Roles.of(roles)
    forms = stored(short_forms(names, order), "forms")
    passes = spark.sparkContext.broadcast(form_filter(forms))

    @F.pandas_udf("array<string>")
    def asked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        maybe = FormFilter(passes.value)
        for texts in batches:
            yield pd.Series([sorted(asked_forms(t.split(" "), words_of, maybe, maybe.ends)) if t else [] for t in texts], dtype=object)

    @F.pandas_udf("string")
    def replaced(texts: pd.Series, patterns: pd.Series, ids: pd.Series) -> pd.Series:
        return pd.Series([" ".join(with_ids(t.split(" "), words_of, dict(zip(p, i, strict=True)))) for t, p, i in zip(texts, patterns, ids, strict=True)], dtype=object)

    plain = strip_punctuation(scrub_badges(F.lower(text)))
    clean = narratives.select(key, F.trim(F.regexp_replace(plain, UNEVEN, " ")).alias(text)).withColumn("_row", F.xxhash64(key, text))
    read = stored(clean.withColumn("_asked", asked(text)), "read")
    # forms found for another row of the same hash change nothing: all that matter for a text were asked for it
    wanted = read.select("_row", F.explode("_asked").alias("_run"))
    wanted = wanted.select("_row", "_run", F.explode(F.array_distinct(F.array("_run", F.regexp_replace("_run", "^([^ ]+) [a-z] ([^ ]+)$", f"$1 {GUESS} $2")))).alias("pattern"))
    # in order of people, so that the last one of a run's forms counts
    hits = wanted.join(forms, "pattern").groupBy("_row").agg(F.sort_array(F.collect_set(F.struct("_order", F.col("_run").alias("run"), "id"))).alias("_hits"))
    both = read.select(key, text, "_row").join(hits, "_row", "left")
    new = F.when(F.col("_hits").isNotNull(), replaced(F.coalesce(text, F.lit("")), F.coalesce("_hits.run", F.array().cast("array<string>")), F.coalesce("_hits.id", F.array().cast("array<string>"))))
    return both.select(key, F.coalesce(new, text).alias(text))
