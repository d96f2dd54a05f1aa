"""Secrets in texts, confirmed by their structure.

Base kinds (assign, access, hex) are reported by their form.  The method adds what it can decode:

* ``der``: a base64 or hex candidate whose bytes are one DER sequence, every nested length
  filling its parent exactly and the leading members being those of a key;
* ``openssh``: a base64 candidate with the OpenSSH magic and length-prefixed strings inside;
* ``pem``: a key block between its BEGIN and END lines whose body decodes to either of them;
* ``jwt``: three base64url parts whose first decodes to a JSON object with ``alg`` and whose
  second decodes to a JSON object.

Rows are read in Arrow batches and nothing is shuffled.  Each pattern passes over a text once.
Defined cases: a null text is empty; an empty text has no spans; repeated rows are reported each;
spans of different kinds may overlap; positions count code points, the end is exclusive.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import documents, ship_by_value

ship_by_value(__name__)

# The forms of the base kinds, in the order in which they are listed.
BASE_KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

ADDED_KINDS = ("pem", "jwt", "openssh", "der")
_PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ ){0,3}PRIVATE KEY)-----([A-Za-z0-9+/=\s]*)-----END \1-----")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}={0,2}")
_LONG_HEX = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}(?![0-9A-Fa-f])")
_OPENSSH = b"openssh-key-v1\0"
#: nested sequences deeper than this are no key
_DEPTH = 16

Span = tuple[int, int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, order of the kind, end, kind), sorted."""
    out: list[Span] = []
    lowered = text.lower()
    if any(k in lowered for k in _KEYWORDS) or not text.isascii():
        out += [(m.start(), 0, m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(out)


def _tlv(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the value at ``at``; None if it does not lie inside."""
    if end - at < 2:
        return None
    tag, n = data[at], data[at + 1]
    at += 2
    if n & 0x80:
        size = n & 0x7F
        if not 1 <= size <= 4 or end - at < size or data[at] == 0:
            return None
        n = int.from_bytes(data[at : at + size], "big")
        at += size
        if n < 0x80:
            return None
    return (tag, at, at + n) if at + n <= end else None


def _tags(data: bytes, at: int, end: int, depth: int = 0) -> list[int] | None:
    """The tags of the members that fill [at, end); nested members must fill theirs too."""
    tags: list[int] = []
    while at < end:
        part = _tlv(data, at, end)
        if part is None or depth > _DEPTH:
            return None
        tag, at, stop = part
        if tag & 0x20 and _tags(data, at, stop, depth + 1) is None:
            return None
        tags.append(tag)
        at = stop
    return tags


def is_key_der(data: bytes) -> bool:
    """One sequence that fills the bytes: version and numbers or octets, version and algorithm
    (private keys), or algorithm and bits (public keys)."""
    outer = _tlv(data, 0, len(data))
    if outer is None or outer[0] != 0x30 or outer[2] != len(data) or len(data) < 32:
        return False
    tags = _tags(data, outer[1], outer[2])
    if not tags:
        return False
    private = tags[0] == 0x02 and (tags[1:3] in ([0x30, 0x04], [0x04, 0xA0], [0x04, 0xA1]) or tags[1:] == [0x04] or len(tags) >= 5 and set(tags) == {0x02})
    return private or tags in ([0x30, 0x03], [0x30, 0x04])


def is_openssh(data: bytes) -> bool:
    """The magic, then three strings, a count, and at least one string, each with its length."""
    if not data.startswith(_OPENSSH):
        return False
    at = len(_OPENSSH)
    for step in range(5):
        if len(data) - at < 4:
            return False
        n = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if step != 3:
            at += n
        if at > len(data):
            return False
    return True


def _unbase64(text: str, url: bool = False) -> bytes:
    try:
        padded = text.rstrip("=")
        padded += "=" * (-len(padded) % 4)
        return base64.b64decode(padded, b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return b""


def _json_object(part: str) -> dict | None:
    try:
        value = json.loads(_unbase64(part, url=True))
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def added_spans(text: str) -> list[Span]:
    """Confirmed candidates only; a key inside a reported block is not reported again."""
    out: list[Span] = []
    if "-----BEGIN " in text:
        for m in _PEM.finditer(text):
            body = _unbase64("".join(m[2].split()))
            if is_key_der(body) or is_openssh(body):
                out.append((m.start(), 3, m.end(), "pem"))
    if "eyJ" in text:
        for m in _JWT.finditer(text):
            head, claims, _ = m[0].split(".")
            header = _json_object(head)
            if header and isinstance(header.get("alg"), str) and _json_object(claims) is not None:
                out.append((m.start(), 4, m.end(), "jwt"))
    inside = list(out)
    for m in _BASE64.finditer(text):
        if m[0][0] == "M" or m[0].startswith("b3BlbnNzaC1r"):  # the first bits of a sequence tag, and of the magic
            data = _unbase64(m[0])
            kind = "der" if is_key_der(data) else "openssh" if is_openssh(data) else ""
            if kind and not any(a <= m.start() < e for a, _, e, _ in inside):
                out.append((m.start(), 6 if kind == "der" else 5, m.end(), kind))
    for m in _LONG_HEX.finditer(text):
        if m[0].startswith("30") and is_key_der(bytes.fromhex(m[0])):
            out.append((m.start(), 6, m.end(), "der"))
    return sorted(set(out))


def _row(text: str | None) -> tuple[list[Span], list[Span]]:
    text = text or ""
    return base_spans(text), added_spans(text)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("kind", pa.string())]))
    for batch in batches:
        both = [_row(x.as_py()) for x in batch.column("text")]
        base = [[{"s": s, "e": e, "kind": k} for s, _, e, k in b] for b, _ in both]
        spans = [[{"s": s, "e": e, "kind": k} for s, _, e, k in sorted(b + a)] for b, a in both]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(base, kind), pa.array(spans, kind)], ["doc_id", "base", "spans"])


def secret_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, base, spans``: arrays of (s, e, kind) by start, then kind; ``spans`` holds the base too."""
    work = documents(docs)
    kind = "array<struct<s:int,e:int,kind:string>>"
    return work.mapInArrow(_batches, f"doc_id {work.schema['doc_id'].dataType.simpleString()}, base {kind}, spans {kind}")


def _joined(spans: list[dict]) -> str:
    return ",".join(f"{x['kind']}:{x['s']}:{x['e']}" for x in spans)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base = [x or [] for x in batch.column("base").to_pylist()]
        columns = [batch.column("doc_id")]
        columns += [pa.array([sum(x["kind"] == k for x in b) for b in base], pa.int64()) for k in BASE_KINDS]
        columns.append(pa.array([hashlib.sha256(_joined(b).encode()).hexdigest() for b in base], pa.string()))
        columns.append(pa.array([_joined(x or []) for x in batch.column("spans").to_pylist()], pa.string()))
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans"])


def digest(found: DataFrame) -> DataFrame:
    """Counts by base kind, the digest of the base spans and all spans as text."""
    counts = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    return found.mapInArrow(_digests, f"doc_id {found.schema['doc_id'].dataType.simpleString()}, {counts}, base_sha256 string, spans string")


def _redact(batches: Iterator[pa.RecordBatch], names: list[str], mask: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for value in batch.column("text"):
            text = value.as_py()
            if text:
                b, a = _row(text)
                parts, at = [], 0
                for s, _, e, k in sorted(b + a):
                    if e > at:
                        parts += [text[at : max(s, at)], mask.format(kind=k) if s >= at else ""]
                        at = e
                text = "".join([*parts, text[at:]])
            texts.append(text)
        columns = {n: batch.column(n) for n in names}
        columns["text"] = pa.array(texts, batch.schema.field("text").type)
        if "n_chars" in columns:
            columns["n_chars"] = pa.array([None if t is None else len(t) for t in texts]).cast(batch.schema.field("n_chars").type)
        yield pa.RecordBatch.from_arrays(list(columns.values()), names)


def redact(docs: DataFrame, mask: str = "[{kind}]") -> DataFrame:
    """All rows and columns of the input, every reported span replaced in ``text``; ``n_chars`` follows."""
    names = list(docs.columns)
    return docs.mapInArrow(lambda batches: _redact(batches, names, mask), docs.schema)
