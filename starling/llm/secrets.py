"""Secret scan: fixed patterns plus an assignment-aware lexer over source and configuration syntax."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the scan (given with the task): kind, pattern, the group whose length counts, least length.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_RUN = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "literal")
_HEX_BYTES = bytes(0x78 if chr(b) in "0123456789abcdef" else 0x20 for b in range(256))

# Parts of a target name and how sensitive a value assigned to it is.
NAME_WEIGHTS = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.7, "secret": 1.0, "token": 0.9,
                "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "private": 0.6, "auth": 0.6, "key": 0.6, "bearer": 0.9,
                "signature": 0.6, "salt": 0.5, "session": 0.4, "cookie": 0.5}
# Values that stand for no secret.
PLACEHOLDERS = frozenset("changeme change_me example placeholder password secret token none null true false undefined "
                         "yourpassword your_password your-password todo redacted default string".split())

# Each alternative scans a run once (possessive repeats), so that lexing takes linear time on any text. A mark of comments
# counts at the start of a line or after white space and only ends a value: settings in comments are lexed like others. A quote
# opens after white space, an operator, a bracket or a string prefix, not inside a word.
LEXEME = re.compile(r"""
    (?P<comment>(?<!\S)(?:\#+|//+))
  | (?P<quoted>(?:(?<![^\s=:,;+>()\[\]{}])|(?<![A-Za-z0-9_])[BFRUbfru]{1,2})
               (?P<body>"(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'|`[^`\n]*+`))
  | (?P<ref>\$\{[A-Za-z_][A-Za-z0-9_.]*+\}|\$[A-Za-z_][A-Za-z0-9_]*+|\{\{\s*+[A-Za-z_][A-Za-z0-9_.]*+\s*+\}\})
  | (?P<op>:=|=>|===?|=|:(?!//))
  | (?P<plus>\+)
  | (?P<word>[A-Za-z0-9_][A-Za-z0-9_./-]*+)
  | (?P<end>[\n;,{}()\[\]])
  | (?P<skip>[^\S\n]++|.)
""", re.X | re.A)
PADDING = re.compile(r"={1,2}(?=[\s;,)\]}]|\Z)")
NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*\Z", re.A)
NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+", re.A)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns: leftmost and non-overlapping per kind, too short matches dropped afterwards."""
    spans = []
    lowered = text.lower()
    if any(w in lowered for w in ("passw", "secret", "token", "api")):
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if b"x" * 32 in text.encode("utf-8", "replace").translate(_HEX_BYTES):
        spans += [("hex", m.start(), m.end()) for m in HEX_RUN.finditer(text)]    # a run of 32+ is one match of [0-9a-f]+
    return spans


def assignments(text: str) -> list[tuple[str, list[tuple[str, object]]]]:
    """``(name, parts)`` of each assignment; a part is ``("lit", (value, start, end))`` or ``("ref", name)``.

    Names may be quoted keys; ``=``, ``:``, ``:=`` and ``=>`` assign; parts joined with ``+`` belong together.
    """
    found, name, parts, wants = [], None, [], False
    last = None                                   # the latest possible target name
    at, size = 0, len(text)

    def close():
        if name is not None and parts:
            found.append((name, list(parts)))

    while at < size:
        m = LEXEME.match(text, at)
        kind, at = m.lastgroup, m.end()
        if kind == "skip":
            continue
        if kind in ("end", "comment"):
            close()
            name, parts, wants, last = None, [], False, None
        elif kind == "op":
            if last is not None:
                if parts and parts[-1][0] != "ref" and parts[-1][1][0] == last:
                    parts.pop()                   # the name of this assignment, not a part of the one before
                close()
                name, parts, wants, last = last, [], True, None
        elif kind == "plus":
            wants = name is not None and bool(parts)
        else:
            if kind == "quoted":
                start, inner = m.start("body") + 1, m["body"][1:-1]
            else:
                start, inner = m.start(), m.group()
                inner = re.sub(r"[${}\s]", "", inner) if kind == "ref" else inner.rstrip(".")
            if wants:
                padding = PADDING.match(text, at) if kind == "word" else None
                if padding:
                    at, inner = padding.end(), text[start:padding.end()]
                if kind == "ref":
                    parts.append(("ref", inner))
                else:
                    literal = kind == "quoted" or not NAME.match(inner)
                    parts.append(("lit" if literal else "word", (inner, start, start + len(inner))))
                wants = False
            elif name is not None and parts and kind != "quoted":
                close()                           # a second word on the line ends the value
                name, parts = None, []
            last = inner.rpartition("/")[2] if kind == "word" else inner
            last = last if NAME.match(last) else None
    close()
    return found


def name_weight(name: str) -> float:
    parts = [p.lower() for p in NAME_PARTS.findall(name)]
    joined = "".join(parts)
    weight = max((NAME_WEIGHTS.get(p, 0.0) for p in parts), default=0.0)
    return max(weight, NAME_WEIGHTS["apikey"] if "apikey" in joined else 0.0)


def literal_strength(value: str) -> float:
    """0 for short, placeholder or prose-like values, else bits of entropy per character over 3, at most 1.

    Values of one character class have 0.4 up to 23 characters, their entropy over 4 from 24 on or in blank-separated groups
    of one length (at least three of 3). Such groups and values with blanks and a digit count without their blanks; four or
    more other words of small letters have 0.5, further ones with blanks 0.
    """
    words = value.split()
    if len(value) < 8 or any(w.lower() in PLACEHOLDERS for w in words):
        return 0.0
    grouped = False
    if len(words) > 1:
        grouped = len(words) > 2 and len({len(w) for w in words}) == 1 and len(words[0]) >= 3
        if not grouped and not any(c.isdigit() for c in value):
            return 0.5 if len(words) >= 4 and all(w.isalpha() and w.islower() for w in words) else 0.0
    value = "".join(words)
    n = len(value)
    if n < 8:
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    mixed = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    if mixed >= 2:
        return min(1.0, entropy / 3.0)
    return min(1.0, entropy / 4.0) if n >= 24 or grouped else 0.4


def lexed_spans(text: str, threshold: float = 0.5) -> list[tuple[str, int, int]]:
    """Literals that reach a sensitive name, directly or through constants defined anywhere in the text.

    A name keeps the parts of its latest assignment. Names are taken from the most sensitive down, so each constant is
    followed once in a text, with the greatest weight that reaches it; cycles end.
    """
    if "=" not in text and ":" not in text:
        return []
    pairs = assignments(text)
    constants = dict(pairs)
    found, seen = set(), set()
    weighed = [(weight, parts) for name, parts in pairs if (weight := name_weight(name))]

    for weight, parts in sorted(weighed, key=lambda w: -w[0]):
        pending = list(parts)
        while pending:
            kind, value = pending.pop()
            target = None if kind == "lit" else value if kind == "ref" else value[0]
            if target in constants:
                if target not in seen:
                    seen.add(target)
                    pending += constants[target]
            elif kind != "ref" and weight * literal_strength(value[0]) >= threshold:
                found.add(("literal", value[1], value[2]))
    return sorted(found)


def all_spans(text: str, threshold: float = 0.5) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """``(base, all)`` spans, each by start, then kind as in KINDS; offsets are code points, ends exclusive."""
    order = KINDS.index
    base = sorted(base_spans(text), key=lambda s: (s[1], order(s[0]), s[2]))
    both = sorted({*base, *lexed_spans(text, threshold)}, key=lambda s: (s[1], order(s[0]), s[2]))
    return base, both


def spans_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per row of ``documents``: doc_id and ``spans`` (array of kind, start, end, base).

    The fixed kinds are ``assign``, ``access`` and ``hex``; ``literal`` spans come from the lexer: name-literal pairs of
    source and configuration syntax, constants propagated within the text, literals scored by the sensitivity of their
    target names. Null texts count as empty and have no spans; repeated rows are scanned each; an empty table gives an
    empty result; other columns are not read. Whole texts are scanned, one at a time, in a narrow map.
    """
    fields = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                base, both = all_spans(text, threshold) if text else ([], [])
                base = set(base)
                rows.append([{"kind": k, "start": a, "end": b, "base": (k, a, b) in base} for k, a, b in both])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, pa.list_(span))], names=["id", "spans"])

    id_type = fields.schema["id"].dataType.simpleString()
    out = fields.mapInArrow(run, f"id {id_type}, spans array<struct<kind:string,start:long,end:long,base:boolean>>")
    return out.withColumnRenamed("id", id_col)


def digest(scanned: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """Counts of the fixed kinds, SHA-256 of their spans' text and the text of all spans, from ``scan``."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of_kind(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    return scanned.select(F.col(id_col), *[of_kind(k) for k in KINDS[:3]],
                          F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
