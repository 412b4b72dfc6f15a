"""Secret scans with structural confirmation.

Base patterns find assignments, access keys and long hex runs.  On top, runs of
base64 and hex are decoded, and a span is reported only when the bytes have the
structure of a key: DER whose nested lengths fit, an OpenSSH key whose length
fields fit, a PEM block around one of these, or a signed token whose header and
claims are JSON objects and whose header names an algorithm.

Cases: null and empty texts have no spans; texts of any length are read whole;
repeated rows are scanned each on its own; an empty table gives an empty one.
Offsets are code points, end exclusive.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwright.llm.common import map_rows, texts, with_fields

#: Kinds in the order in which spans with an equal start are listed.
KINDS = ("assign", "access", "hex", "pem", "jwt", "der", "openssh")

ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{1,64})-----([A-Za-z0-9+/=\s]{16,}?)-----END \1-----")
JWT = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
BASE64 = re.compile(r"[A-Za-z0-9+/]{40,}={0,2}")
ANY_HEX = re.compile(r"[0-9A-Fa-f]{64,}")


def nested(data: bytes, start: int, end: int, depth: int = 0) -> int:
    """Number of DER values that fill a range exactly, nested ones included; 0 if they don't.

    Lengths must be written in the shortest form.  An explicit stack keeps deep
    nesting from exhausting the interpreter's.
    """
    count, todo = 0, [(start, end)]
    while todo:
        at, stop = todo.pop()
        while at < stop:
            if at + 2 > stop or data[at] & 0x1F == 0x1F or data[at] == 0:
                return 0
            tag, size, head = data[at], data[at + 1], 2
            if size >= 0x80:
                width = size & 0x7F
                if not 1 <= width <= 4 or at + 2 + width > stop or data[at + 2] == 0:
                    return 0
                size, head = int.from_bytes(data[at + 2 : at + 2 + width], "big"), 2 + width
                if size < 0x80:
                    return 0
            if at + head + size > stop:
                return 0
            if tag & 0x20:
                todo.append((at + head, at + head + size))
            count += 1
            at += head + size
    return count


def is_der(data: bytes) -> bool:
    """One SEQUENCE over all bytes that holds an INTEGER or a SEQUENCE first, and two values at least."""
    if len(data) < 24 or data[0] != 0x30:
        return False
    head = 2 + (data[1] & 0x7F if data[1] >= 0x80 else 0)
    return len(data) > head and data[head] in (0x02, 0x30) and nested(data, 0, len(data)) >= 3


def is_openssh(data: bytes) -> bool:
    """An OpenSSH private key (magic, then length-prefixed fields) or a public key blob."""
    magic = b"openssh-key-v1\0"
    if data.startswith(magic):
        at = len(magic)
        for _ in range(3):  # cipher, derivation and its options
            if at + 4 > len(data):
                return False
            at += 4 + int.from_bytes(data[at : at + 4], "big")
        return at + 4 <= len(data) and 1 <= int.from_bytes(data[at : at + 4], "big") <= 64
    at = fields = 0
    while at + 4 <= len(data):
        size = int.from_bytes(data[at : at + 4], "big")
        if not fields and not re.match(rb"(ssh-|ecdsa-|sk-)[a-z0-9@.-]+$", data[4 : 4 + size]):
            return False
        at, fields = at + 4 + size, fields + 1
    return at == len(data) and fields >= 2


def decoded(text: str) -> bytes | None:
    """Bytes of a base64 run without white space; a cut last group is left off."""
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def structure(data: bytes | None) -> str | None:
    if not data:
        return None
    return "der" if is_der(data) else "openssh" if is_openssh(data) else None


def is_token(head: str, claims: str) -> bool:
    """Header and claims are JSON objects; the header names its algorithm."""
    parts = []
    for part in (head, claims):
        data = decoded(part)
        try:
            parts.append(json.loads(data) if data else None)
        except (ValueError, RecursionError):
            return False
    return isinstance(parts[0], dict) and isinstance(parts[1], dict) and "alg" in parts[0]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of the base patterns, matches that fail the length tests dropped."""
    found = [
        (m.start(), m.end(), "assign")
        for m in ASSIGN.finditer(text)
        if m.end(2) - m.start(2) >= 8
    ]
    if "AKIA" in text:
        found += [
            (m.start(), m.end(), "access")
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= 16
        ]
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans whose decoded bytes have the structure of a key or token."""
    found = []
    if "-----BEGIN " in text:
        for m in PEM.finditer(text):
            if structure(decoded("".join(m[2].split()))):
                found.append((m.start(), m.end(), "pem"))
    if "eyJ" in text:
        for m in JWT.finditer(text):
            if is_token(m[1], m[2]):
                found.append((m.start(), m.end(), "jwt"))
    blocks = [(a, b) for a, b, kind in found if kind == "pem"]
    for m in BASE64.finditer(text):
        inside = any(a <= m.start() < b for a, b in blocks)
        if not inside and (kind := structure(decoded(m[0]))):
            found.append((m.start(), m.end(), kind))
    for m in ANY_HEX.finditer(text):
        if len(m[0]) % 2 == 0 and (kind := structure(bytes.fromhex(m[0]))):
            found.append((m.start(), m.end(), kind))
    return found


def spans(text: str) -> tuple[list, list]:
    """Base spans and all spans, each by start and then by kind as listed."""
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    base = sorted(base_spans(text), key=order)
    return base, sorted({*base, *confirmed_spans(text)}, key=order)


def _joined(found: list) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in found)


def scan(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: counts of base matches, a digest of their spans, and all spans."""
    schema = with_fields(
        documents, [key],
        "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    )

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            found = [spans(t) for t in texts(batch.column(1))]
            count = lambda k: [sum(s[2] == k for s in base) for base, _ in found]
            return {
                key: batch.column(0),
                "n_assign": count("assign"),
                "n_access": count("access"),
                "n_hex": count("hex"),
                "base_sha256": [hashlib.sha256(_joined(b).encode()).hexdigest() for b, _ in found],
                "spans": [_joined(every) for _, every in found],
            }

        return work

    return map_rows(documents.select(key, text), schema, make)


def redacted(text: str | None, mark: str = "[secret]") -> str | None:
    """A text with every span replaced; of an assignment only the value goes."""
    if not text:
        return text
    hidden = [
        (m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8
    ]
    hidden += [(a, b) for a, b, kind in spans(text)[1] if kind != "assign"]
    out, at = [], 0
    for a, b in sorted(hidden):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mark]
        at = b
    return "".join(out) + text[at:] if out else text


def redact(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents with secrets replaced by a mark and ``n_chars`` brought up to date."""
    def make():
        def work(batch: pa.RecordBatch) -> dict:
            out = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            new = [redacted(t) for t in out[text].to_pylist()]
            out[text] = pa.array(new, type=pa.string())
            return out

        return work

    clean = map_rows(documents, documents.schema, make)
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.length(text).cast(kind))
    return clean.select(documents.columns)
