"""Secrets in text: fixed patterns, and an assignment-aware lexer over source and configuration syntax."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstrata.llm.source_lexer import reached, read_source

# Fixed values of the scan's contract.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "named")

_SENSITIVE = re.compile(
    r"(?:^|_)(?:password|passwd|pass|pwd|passphrase|secret|token|apikey|api_key|access_key|private_key|"
    r"auth|credential|credentials|signing_key|encryption_key|client_key)(?:_|$)"
)
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
#: A sensitive name holds one of these, in either case.
_STEMS = re.compile("pass|pwd|secret|token|key|auth|credential", re.ASCII | re.IGNORECASE)
#: How templates write what is filled in later.
_TEMPLATE = re.compile(r"\$\{|\{\{|%\(|<[A-Za-z_]|\$[A-Za-z_(]")
_PLACEHOLDERS = {"changeme", "example", "placeholder", "none", "null", "true", "false", "undefined", "redacted", "xxxxxxxx"}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns, leftmost and not overlapping within a kind."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in _WORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def entropy(value: str) -> float:
    """Bits a character of a literal's own distribution."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values()) if value else 0.0


def literal_score(name: str, value: str) -> float:
    """0 to 1: how likely a literal given to this name is a secret.

    The name must be sensitive by itself; variety of signs, length and digits of the literal add up.
    """
    plain = _CAMEL.sub("_", name).lower().replace("-", "_").replace(".", "_")
    if not _SENSITIVE.search(plain) or len(value) < 8 or value.lower() in _PLACEHOLDERS or " " in value or _TEMPLATE.match(value):
        return 0.0
    signs = any(c.isdigit() for c in value) + any(c.isalpha() for c in value) + any(not c.isalnum() for c in value)
    return min(1.0, 0.3 + 0.12 * min(entropy(value), 4.0) + 0.1 * (signs - 1) + 0.01 * min(len(value), 20))


def named_spans(text: str, threshold: float = 0.7) -> list[tuple[int, int, int]]:
    """Literals reached by sensitive names, directly or through any chain of constants, assigned earlier or later.

    A literal in pieces is scored as a whole; each piece is a span. Texts without any sensitive word are not lexed.
    """
    if not _STEMS.search(text):
        return []
    reading = read_source(text)
    sensitive = {name for name, _ in reading.aliases if literal_score(name, "a1B2c3D4e5F6g7H8") >= threshold}
    carried = reached(reading.aliases, sensitive)
    found = set()
    for given in reading.given:
        # Names that end up in a sensitive one carry its sensitivity back to the literal they hold.
        name = "secret" if given.name in carried else given.name
        if max(literal_score(name, given.value), literal_score(given.name, given.value)) >= threshold:
            found |= {(start, 3, end) for start, end in given.pieces}
    return sorted(found)


def all_spans(text: str) -> list[tuple[int, int, int]]:
    """Base spans, and the lexer's spans that no base span of kind assign or hex already covers."""
    base = base_spans(text)
    more = [x for x in named_spans(text) if not any(b[0] <= x[0] and x[2] <= b[2] for b in base)]
    return sorted(base + more)


def _join(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """The text with every span, overlapping ones merged, replaced by ``mark``."""
    out, at = [], 0
    for start, _, end in spans:
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


_COLUMNS = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan_secrets(documents: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row a document: counts a kind, a digest of the base spans, and all spans.

    NULL text is empty; an empty list has the digest of an empty string and empty ``spans``. Ids may be NULL or
    repeat, every row is scanned by itself, and other columns are not read, whatever their names. Each batch of rows is
    streamed through a task, so nothing is shuffled. Texts are scanned whole. Spans that begin together are ordered by
    kind. An empty table gives an empty one.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1).to_pylist():
                spans = all_spans(value or "")
                base = [x for x in spans if x[1] < 3]
                kinds = Counter(x[1] for x in base)
                rows.append((kinds[0], kinds[1], kinds[2], hashlib.sha256(_join(base).encode()).hexdigest(), _join(spans)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), *(pa.array(c, pa.string()) for c in columns[3:])],
                names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    kind = documents.schema[id_column].dataType.simpleString()
    rows = documents.select(F.col(id_column).alias("id"), F.col(text).cast("string"))
    return rows.mapInArrow(scan, f"id {kind}, {_COLUMNS}").withColumnRenamed("id", id_column)


def redact_secrets(documents: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with the secrets in ``text`` replaced; NULL text stays NULL, no row goes.

    Overlapping spans are replaced as one. Texts are read whole; an empty table stays empty.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            values = [None if v is None else redact(v, all_spans(v), mark) for v in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(values, batch.schema.field(at).type))

    return documents.mapInArrow(scan, documents.schema)
