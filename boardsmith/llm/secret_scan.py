"""Secret scans: an Aho-Corasick keyword prefilter, anchored expressions near its hits, checksums last.

One automaton over the lower-cased bytes of a text finds every keyword; an expression is tried only where its
keyword stands, and kinds with an embedded checksum (token CRC-32, card and account check digits) are kept only if
it holds.  Runs of hex digits have no keyword; they are found by the same kind of byte search over a map of the
text to digit classes.  Expressions are bounded or give nothing back, so a text costs time in proportion to its length.

Spans are code points, end exclusive, over the whole text.  Defined cases: null text counts as empty; spans of one
kind never overlap, leftmost first; ids may be null or repeated, each row is scanned alone; an empty
table gives no rows; other columns are ignored by ``scan`` and passed through by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardsmith.functions.util import pieces
from boardsmith.llm.common import prepare

# The kinds in order, the base kinds first; their keywords (lower case) and expressions.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm", "card", "iban", "jwt", "pem")
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "api_key", "apikey"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "card": ("card", "visa", "mastercard"),
    "iban": ("iban",),
    "jwt": ("eyj",),
    "pem": ("-----begin",),
}
PATTERNS = {
    "assign": re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "github": re.compile(rb"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "npm": re.compile(rb"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "card": re.compile(rb"[A-Za-z]{1,32}+[^0-9\n]{0,16}+([0-9](?:[ -]?[0-9]){11,18})(?![0-9])", re.I),
    "iban": re.compile(rb"(?i:iban)[:=]?\x20*+([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){10,30})(?![A-Za-z0-9])"),
    "jwt": re.compile(rb"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    "pem": re.compile(rb"-----BEGIN (?:[A-Z0-9]{1,20}+ ){0,4}?PRIVATE KEY-----"),  # the header; KeyBlocks finds the rest
}
PEM_END = re.compile(rb"-----END (?:[A-Z0-9]{1,20}+ ){0,4}?PRIVATE KEY-----")
PEM_BODY = re.compile(rb"[A-Za-z0-9+/=\s:,-]*+")
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
HEX_LEAST, ACCESS_LEAST, ASSIGN_LEAST = 32, 16, 8
_HEX_CLASS = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))


def _token_crc(m: re.Match) -> bool:
    """The last six characters are the CRC-32 of the part before, in base 62."""
    value = 0
    for c in m[2]:
        value = value * 62 + BASE62.index(c)
    return value == zlib.crc32(m[1])


def _luhn(m: re.Match) -> bool:
    digits = [c - 48 for c in reversed(m[1]) if 48 <= c <= 57]
    doubled = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits)]
    return sum(doubled) % 10 == 0 and len(set(digits)) > 1


def _mod97(m: re.Match) -> bool:
    code = m[1].replace(b" ", b"").upper().decode()
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


VALID = {
    "assign": lambda m: len(m[2]) >= ASSIGN_LEAST,
    "access": lambda m: len(m[0]) >= ACCESS_LEAST,
    "github": _token_crc, "npm": _token_crc, "card": _luhn, "iban": _mod97,
}


class KeyBlocks:
    """Ends of key blocks in one text.  What is known of the text behind a header is kept for later headers, so that many
    headers without an end cost one pass together."""

    def __init__(self, data: bytes):
        self.data, self.end, self.body = data, (0, 0), (0, 0)  # the next end mark; a run of bytes that a body may hold

    def close(self, at: int) -> int | None:
        """Where the block whose header ends at ``at`` ends, if it does."""
        if self.end is not None and self.end[0] < at:
            m = PEM_END.search(self.data, at)
            self.end = m and m.span()
        if self.end is None:  # no end mark from here on
            return None
        if not self.body[0] <= at <= self.body[1]:
            self.body = at, PEM_BODY.match(self.data, at).end()
        return self.end[1] if self.end[0] <= self.body[1] else None


class Scanner:
    def __init__(self):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for kind, words in KEYWORDS.items():
            for w in words:
                self.automaton.add_word(w, (kind, len(w)))
        self.automaton.make_automaton()

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, kind's index, end) in bytes, sorted."""
        found, free, keys = [], dict.fromkeys(KINDS, 0), KeyBlocks(data)
        for last, (kind, size) in self.automaton.iter(data.lower().decode("latin-1")):
            at = last + 1 - size
            if at < free[kind] or not (m := PATTERNS[kind].match(data, at)):
                continue
            end = keys.close(m.end()) if kind == "pem" else m.end()
            if end is None:
                continue
            free[kind] = end  # a failing match still takes its place
            if kind not in VALID or VALID[kind](m):
                found.append((m.start(), KINDS.index(kind), end))
        classes, at = data.translate(_HEX_CLASS), 0
        while (at := classes.find(b"x" * HEX_LEAST, at)) >= 0:
            end = classes.find(b" ", at)
            end = len(data) if end < 0 else end
            found.append((at, KINDS.index("hex"), end))
            at = end
        return sorted(found)


def code_points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans with byte offsets turned into code points, in one pass over the text."""
    if not spans or data.isascii():
        return spans
    where, at, points = {}, 0, 0
    for offset in sorted({x for s, _, e in spans for x in (s, e)}):
        points += len(data[at:offset].decode())
        at = offset
        where[offset] = points
    return [(where[s], k, where[e]) for s, k, e in spans]


_SCANNER: list[Scanner] = []


def scanner() -> Scanner:
    if not _SCANNER:
        _SCANNER.append(Scanner())
    return _SCANNER[0]


SCAN_SCHEMA = "doc_id {id}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_spans bigint"


def _scan(batches):
    scan = scanner()
    for b in (p for whole in batches for p in pieces(whole)):
        rows = []
        for t in b.column(1).cast(pa.binary()):
            data = t.as_py() or b""
            spans = code_points(data, scan.spans(data))
            told = [f"{KINDS[k]}:{s}:{e}" for s, k, e in spans]
            base = ",".join(x for x, (_, k, _) in zip(told, spans, strict=True) if k < len(BASE_KINDS))
            n = [sum(k == i for _, k, _ in spans) for i in range(len(BASE_KINDS))]
            rows.append((*n, hashlib.sha256(base.encode()).hexdigest(), ",".join(told), len(spans)))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
        kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
        yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]],
                                         ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_spans"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts of the base kinds, their digest and all spans as ``kind:start:end``, comma-joined."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(_scan, SCAN_SCHEMA.format(id=rows.schema["doc_id"].dataType.simpleString()))


def _redacted(data: bytes, spans: list[tuple[int, int, int]]) -> bytes:
    parts, at = [], 0
    for s, k, e in spans:
        if s >= at:
            parts += [data[at:s], b"[" + KINDS[k].upper().encode() + b"]"]
        at = max(at, e)
    return b"".join([*parts, data[at:]])


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every secret in ``text_col`` replaced by its kind in brackets; all rows and columns stay, null text stays null."""
    prepare(docs.sparkSession)
    place = docs.columns.index(text_col)

    def run(batches):
        scan_ = scanner()
        for b in (p for whole in batches for p in pieces(whole)):
            texts = [t.as_py() for t in b.column(place).cast(pa.binary())]
            clean = [None if t is None else _redacted(t, scan_.spans(t)) for t in texts]
            cols = [pa.array(clean, pa.binary()).cast(pa.string()) if i == place else b.column(i) for i in range(b.num_columns)]
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return docs.mapInArrow(run, docs.schema)
