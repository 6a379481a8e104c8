"""Secret scan: three fixed patterns, and an assignment-aware reading of source and configuration lines.

The reading finds ``name = value`` pairs (``=``, ``:``, ``:=``, ``=>``; names bare or quoted) line by line. A value is
a sum of quoted literals and names of constants, or one bare word. Constants are propagated: a name that was given a
value before stands for it, so a literal counts for every name that it reaches. A literal is reported when the
sensitivity of the name and the look of the value reach ``LEAST_SCORE`` together. Added spans have the
kinds ``literal`` (under its own name) and ``constant`` (reached through another name).

Defined cases: null and empty texts have no spans; offsets are code points, the end is exclusive; spans of different
kinds may overlap; repeated rows are scanned each; columns of any other name are handed through.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideframe.llm.batches import in_batches, packed_row, row_schema

KINDS = ("assign", "access", "hex", "literal", "constant")
# The three base patterns. Lengths of 16 and 32 are asked for here, which finds the same maximal runs.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE = 8

_QUOTED = r"""(?:"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)"""
_NAME = r"[A-Za-z_$][A-Za-z0-9_.$-]*+"
# a bare name starts a run of name characters (after its digits), so a run is read once, however long it is
PAIR = re.compile(
    rf"""(?:(?<![A-Za-z0-9_.$-])[0-9.-]*+(?P<bare>{_NAME})|["'](?P<quoted>[A-Za-z_$][^"'\n]*+)["'])(?:\[["'](?P<item>[^"'\]\n]+)["']\])?"""
    rf"""[ \t]*(?::=|=>|[:=])(?![:=/])[ \t]*(?P<value>(?:{_QUOTED}|{_NAME})(?:[ \t]*\+[ \t]*(?:{_QUOTED}|{_NAME}))+|{_QUOTED}|[^\s"'`,;(){{}}\[\]<>]+)"""
)
TERM = re.compile(rf"{_QUOTED}|{_NAME}")
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
#: How much a part of a name tells that its value is secret.
SENSITIVE = {
    "password": 3, "passwd": 3, "passphrase": 3, "pwd": 3, "pass": 2, "secret": 3, "credential": 3, "credentials": 3,
    "token": 3, "apikey": 3, "bearer": 3, "auth": 2, "authorization": 2, "private": 2, "signing": 2, "encryption": 2,
    "key": 1, "api": 1, "access": 1, "client": 1, "session": 1, "salt": 1, "hash": 1,
}
#: Words that stand where a secret will be put.
STAND_INS = {"changeme", "example", "placeholder", "password", "secret", "none", "null", "true", "false", "undefined", "redacted", "your"}
LEAST_SCORE = 5.0


def name_score(name: str) -> float:
    """Sum over the parts of a name in any spelling: DB_PASSWORD, dbPassword, db.password."""
    return float(sum(SENSITIVE.get(part.lower(), 0) for part in PARTS.findall(name)))


def value_score(value: str) -> float:
    """0 to 4: length, mixed characters and entropy; nothing for short values, stand-ins and references."""
    if len(value) < LEAST_VALUE or value[0] in "$<%{*" or " " in value.strip():
        return 0.0
    if STAND_INS & {part.lower() for part in PARTS.findall(value)} or len(set(value)) < 4:
        return 0.0
    counts = Counter(value)
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    kinds = any(c.isdigit() for c in value) + any(c.islower() for c in value) + any(c.isupper() for c in value)
    return (1.0 if len(value) >= 12 else 0.5) + (kinds >= 2) + (entropy >= 3.0) + (entropy >= 3.5 and kinds >= 2)


def read_pairs(text: str) -> Iterator[tuple[str, list[tuple[str, int, int]]]]:
    """(name, terms) of every assignment; a term is (source, start, end), without quotes for literals."""
    start = 0
    for line in text.split("\n"):
        if "=" in line or ":" in line:
            for found in PAIR.finditer(line):
                name = found["item"] or found["bare"] or found["quoted"]
                value, at = found["value"], start + found.start("value")
                terms = []
                if value[0] in "\"'`" or "+" in value and TERM.match(value):
                    for term in TERM.finditer(value):
                        quoted = term[0][0] in "\"'`"
                        terms.append((term[0], at + term.start() + quoted, at + term.end() - quoted))
                else:
                    terms.append((value, at, at + len(value)))
                yield name, terms
        start += len(line) + 1


def literal_spans(text: str) -> set[tuple[str, int, int]]:
    """Spans of literals that reach a sensitive name, directly or through constants."""
    if "=" not in text and ":" not in text:
        return set()
    known: dict[str, tuple[str, list[tuple[int, int]]]] = {}
    spans: set[tuple[str, int, int]] = set()
    for name, terms in read_pairs(text):
        value, own, reached = "", [], []
        for source, a, b in terms:
            if source[0] in "\"'`":
                value += source[1:-1]
                own.append((a, b))
            elif source in known:
                value += known[source][0]
                reached += known[source][1]
            else:
                value += source
                own.append((a, b))
        known[name] = (value, own + reached)
        score = name_score(name)
        if score >= 2 and (quality := value_score(value)) and score + quality >= LEAST_SCORE:
            spans |= {("literal", a, b) for a, b in own if b > a}
            spans |= {("constant", a, b) for a, b in reached if b > a}
    return spans


def find_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of every span, by start and kind."""
    if not text:
        return []
    spans = [(1, m.start(), m.end()) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    spans += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    if "=" in text or ":" in text:
        spans += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST_VALUE]
        spans += [(KINDS.index(kind), a, b) for kind, a, b in literal_spans(text)]
    return sorted(spans, key=lambda s: (s[1], s[0], s[2]))


def scan_documents(docs: DataFrame) -> DataFrame:
    """Adds ``secrets``, an array of (kind, start, end) by start and kind; a column of that name is replaced."""
    kept = [c for c in docs.columns if c != "secrets"]
    packed = docs.select(packed_row(kept), F.col("text").alias("text"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in find_spans(t.as_py())] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(span))], names=["row", "secrets"])

    schema = row_schema(packed, "secrets array<struct<kind:string,start:bigint,end:bigint>>")
    return in_batches(packed).mapInArrow(scan, schema).select("row.*", "secrets")


def joined(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_digests(scanned: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("secrets", lambda s: s["kind"].isin(*KINDS[:3]))
    return scanned.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(F.encode(joined(base), "UTF-8"), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
        (count("literal") + count("constant")).alias("n_added"),
    )
