"""Secret scans: fixed patterns, and strings that zstandard can't shorten in a sensitive context."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, text_or_empty

# The patterns of the base kinds, and the least lengths.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

KINDS = ("assign", "access", "hex", "novel")
#: Candidates of the novelty measure: runs of key characters, or the values after an inner `=` of them.
CANDIDATE, VALUE, CANDIDATE_LEAST = r"[A-Za-z0-9+/_=-]{16,}", r"[^=]+(?:=+$)?", 16
#: A value right after a name; if the name is sensitive, a shorter value with a digit is a candidate too.
ASSIGNED, ASSIGNED_LEAST = r"""(?:=>|[:=])\s{0,4}["']?([A-Za-z0-9+/_-]{8,}(?:=+(?![A-Za-z0-9+/_=-]))?)""", 8
#: What makes its surroundings sensitive, in the characters just before and after it.
SENSITIVE = r"(?i)secret|token|passw|passphrase|credential|api.?key|access.?key|private.?key|auth|bearer|signature|session"
NAME = rf"""(?:{SENSITIVE[4:]})[\w.-]*["']?\s{{0,4}}$"""
BEFORE, AFTER = 48, 24
#: Letters alone look random if their case changes at this share of places; words and names in camel case change less often.
LEAST_CHANGES = 0.45
#: Code on either side that the compressor has seen already.
AROUND = 1024
#: Marginal bytes for each character. Random hex takes about 0.5, random base64 0.75; known words and names take less.
LEAST_NOVELTY = 0.45

#: Names, words and values common in code, which prime the compressor.
IDENTIFIERS = (
    "access_key access_token account_id active algorithm api_key api_token application argument array attribute "
    "auth_token authentication authorization background base64 bearer boolean buffer callback certificate changeme "
    "client_id client_secret collection column component config configuration connection constructor container "
    "content_type context controller cookie create_table credential database default delete description development "
    "dictionary directory document element encoding encryption endpoint environment example exception expires "
    "expression filename function generator handler header hostname identifier implementation import include index "
    "instance integer interface iterator keyword language length library listener localhost localtime manager "
    "message metadata method middleware model module namespace number object operation option output override package "
    "parameter parent passphrase password path_to_file permission placeholder pointer private_key process production "
    "property protected protocol provider public_key query queue recursive redirect reference refresh_token register "
    "repository request resource response return schema secret_key sequence serializer service session_id "
    "session_token settings signature statement status string structure subscription template temporary test_value "
    "thread timestamp token_type transaction undefined update username utf_8 validator value variable version "
    "webhook_url workspace your_api_key_here your_secret_here 0123456789abcdef ABCDEFGHIJKLMNOPQRSTUVWXYZ "
    "abcdefghijklmnopqrstuvwxyz xxxxxxxxxxxxxxxx 0000000000000000"
).split()


class Taken:
    """Spans, merged where they overlap, so that each question about them is one search."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def overlap(self, start: int, end: int) -> bool:
        k = bisect_right(self.ends, start)
        return k < len(self.starts) and self.starts[k] < end


class Scanner:
    """Finds spans in one text after another. Offsets are code points, ends are exclusive."""

    def __init__(self, identifiers=tuple(IDENTIFIERS), least_novelty: float = LEAST_NOVELTY):
        self.assign = re.compile(ASSIGN, re.ASCII | re.IGNORECASE)
        self.access, self.hex = re.compile(ACCESS), re.compile(HEX)
        self.candidate, self.value, self.sensitive = re.compile(CANDIDATE), re.compile(VALUE), re.compile(SENSITIVE, re.ASCII)
        self.assigned, self.name = re.compile(ASSIGNED), re.compile(NAME, re.ASCII | re.IGNORECASE)
        self.identifiers, self.least_novelty = " ".join(identifiers).encode(), least_novelty
        self.known: dict[tuple[int, int], float] = {}  # of the text at hand

    def base(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end) of the base kinds. A run of hex digits is as long as it can be, so the short ones can be passed over."""
        found = []
        if ":" in text or "=" in text:
            found += [(m.start(), 0, m.end()) for m in self.assign.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
        if "AKIA" in text:
            found += [(m.start(), 1, m.end()) for m in self.access.finditer(text) if len(m[0]) >= ACCESS_LEAST]
        found += [(m.start(), 2, m.end()) for m in self.hex.finditer(text)]
        return sorted(found)

    def novelty(self, text: str, start: int, end: int) -> float:
        """Bytes that the candidate adds to its compressed surroundings, for each of its characters.

        Other copies of the candidate are blank there, or each would make the others compressible.
        """
        if (start, end) not in self.known:
            self.known[start, end] = self.marginal(text, start, end)
        return self.known[start, end]

    def marginal(self, text: str, start: int, end: int) -> float:
        core = text[start:end].strip("=")
        blank, reach = " " * len(core), AROUND + len(core)  # so far that no copy is cut before it is blank
        before = text[max(0, start - reach) : start].replace(core, blank)[-AROUND:]
        after = text[end : end + reach].replace(core, blank)[:AROUND]
        seen = zstandard.ZstdCompressionDict(self.identifiers + b" " + before.encode() + b" " + after.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        compress = zstandard.ZstdCompressor(level=9, dict_data=seen, write_content_size=False, write_dict_id=False).compress
        marker = b"=\n"  # both inputs pay for the frame
        return (len(compress(marker + text[start:end].encode())) - len(compress(marker))) / (end - start)

    def candidates(self, run: str) -> list[tuple[int, int]]:
        """The values of a run, which `=` parts from their names; padding belongs to the last one."""
        return [m.span() for m in self.value.finditer(run) if m.end() - m.start() >= CANDIDATE_LEAST]

    def novel(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Candidates in a sensitive context that overlap no base span and don't compress.

        A name before `=` counts as context of its value. A run none of whose values is found is a candidate itself.
        """
        taken = Taken([(start, end) for start, _, end in base])
        assigned = [m.span(1) for m in self.assigned.finditer(text)] if ":" in text or "=" in text else []
        found = [span for span in assigned if not taken.overlap(*span) and self.is_assigned(text, *span)]
        taken = Taken([*((start, end) for start, _, end in base), *found])
        for m in self.candidate.finditer(text):
            first, last = m.span()
            values = [(first + start, first + end) for start, end in self.candidates(m[0])]
            finds = [span for span in values if self.is_novel(text, *span, taken)]
            if not finds and (first, last) not in values and self.is_novel(text, first, last, taken):
                finds = [(first, last)]
            found += finds
        return [(start, 3, end) for start, end in found]

    def is_assigned(self, text: str, start: int, end: int) -> bool:
        """Whether a sensitive name stands right before, and the value doesn't compress; without a digit it must be long."""
        value = text[start:end]
        if not (any(map(str.isdigit, value)) or len(value) >= CANDIDATE_LEAST) or len(value.rstrip("=")) < ASSIGNED_LEAST:
            return False
        at = start - 1 if text[start - 1] in "\"'" else start
        before = text[max(0, at - BEFORE) : at].rstrip().rstrip("=:>")
        return bool(self.name.search(before)) and self.novelty(text, start, end) >= self.least_novelty

    def is_novel(self, text: str, start: int, end: int, taken: Taken) -> bool:
        if taken.overlap(start, end) or not looks_random(text[start:end]):
            return False
        if not self.sensitive.search(text, max(0, start - BEFORE), start) and not self.sensitive.search(text, end, end + AFTER):
            return False
        return self.novelty(text, start, end) >= self.least_novelty

    def measured(self, text: str, spans: list[tuple[int, int, int]]) -> list[float]:
        """The novelty of each span: that of its value, for a name with its value."""
        out = []
        for start, kind, end in spans:
            first, last = self.assign.match(text, start).span(2) if kind == 0 else (start, end)
            out.append(self.novelty(text, first, last))
        return out

    def scan(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        self.known = {}
        base = self.base(text)
        return base, sorted(base + self.novel(text, base))


def looks_random(value: str) -> bool:
    """A digit, or letters whose case changes again and again."""
    if any(map(str.isdigit, value)):
        return True
    changes = sum(a.islower() != b.islower() for a, b in zip(value, value[1:]))
    return changes >= LEAST_CHANGES * len(value)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long, novelty string"


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    for batch in batches:
        rows: list[list] = [[] for _ in names[1:]]
        for text in batch.column("text"):
            base, spans = scanner.scan(text.as_py())
            kinds = [kind for _, kind, _ in spans]
            for column, value in zip(rows, (kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), kinds.count(3), ",".join(f"{x:.3f}" for x in scanner.measured(text.as_py(), spans))), strict=True):
                column.append(value)
        kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, k) for x, k in zip(rows, kinds, strict=True))], names)


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_novel, novelty for each row of docs; a null text is empty.

    spans joins kind:start:end by start, then kind; a text without any has the empty string. novelty joins the marginal
    compressed bytes a character of all spans, base ones too, in the same order. Repeated rows have a row each; very long texts are
    scanned whole.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(_scan_batches, SCHEMA)


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with each run of overlapping spans replaced by the mark."""
    out, at = [], 0
    reach = 0
    for start, _, end in spans:
        if start >= reach:
            out += [text[at:start], mark]
        at = reach = max(reach, end)
    return "".join([*out, text[at:]]) if spans else text


def _redact_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    for batch in batches:
        out = []
        for text in batch.column("text"):
            if (value := text.as_py()) is not None and (spans := scanner.scan(value)[1]):
                value = redacted(value, spans)
            out.append(value)
        k = batch.schema.get_field_index("text")
        yield batch.set_column(k, batch.schema.field(k), pa.array(out, batch.schema.field(k).type))


def redact(docs: DataFrame) -> DataFrame:
    """docs with every secret replaced by [SECRET] and n_chars, if there, counted anew; null texts stay null."""
    names = [x if x == "text" else f"_{k}" for k, x in enumerate(docs.columns)]
    renamed = docs.toDF(*names)
    out = renamed.mapInArrow(_redact_batches, renamed.schema).toDF(*docs.columns)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op2(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    return secret_spans(documents(spark, sf_dir))
