"""Secret scan with structural confirmation.

Three patterns find assignments, access keys and hex runs. Beyond them, runs of base64 or hex are decoded and parsed,
and reported only where the bytes have the structure of a secret: a DER private key whose nested lengths fit, an
OpenSSH key with its length-prefixed fields, a PEM block around either or around an encrypted key, with or without
header lines and escaped line breaks, or a signed token whose header and payload are JSON objects.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "pem", "token", "der", "ssh")

# The patterns of the base rules.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")

PEM = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----([^-]*(?:-(?!----)[^-]*)*)-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----")
BREAK = re.compile(r"(?<!\\)\\+[nrt]")  # line breaks as JSON and .env files write them
SLASH = re.compile(r"(?<!\\)\\+/")
ENCRYPTED = re.compile(r"\s*Proc-Type:\s*4,\s*ENCRYPTED\s+DEK-Info:\s*([A-Za-z0-9-]+),\s*((?:[0-9A-Fa-f]{2})+)\s")
HEADERS = re.compile(r"\s*(?:[A-Za-z][A-Za-z0-9-]*:[^\n\r]*[\n\r]\s*)*")
SIGNED = re.compile(
    r"(?<![A-Za-z0-9_-])(?<![A-Za-z0-9_-]\.)([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)"
    r"(?![A-Za-z0-9_-]|\.[A-Za-z0-9_-])"
)
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
HEX_RUN = re.compile(r"(?:[0-9a-fA-F]{2}){32,}")
SSH_MAGIC = b"openssh-key-v1\0"
INTEGER, BIT_STRING, OCTET_STRING, OBJECT_ID, SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30

SPARK_SCHEMA = "doc_id long, spans array<struct<kind: string, start: int, end: int>>"
SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def scan(docs: DataFrame) -> DataFrame:
    """All spans of every whole text, one row per input row, in code points with exclusive end.

    Spans are ordered by start, then kind in the order of ``KINDS``. Matches of one kind do not overlap; spans of
    different kinds may. A NULL or empty text has no span. Repeated rows are scanned alike, other columns are
    ignored, an empty input gives no row.
    """
    return docs.select("doc_id", "text").mapInArrow(_scan, SPARK_SCHEMA)


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The input with every span in its texts replaced by ``mark``; overlapping spans make one mark.

    Only ``text`` changes, and ``n_chars``, where present, follows it in rows that had a span. No row is dropped.
    """
    schema = docs.schema
    return docs.mapInArrow(partial(_redact, mark), schema)


def find(text: str) -> list[tuple[str, int, int]]:
    """Spans of one text as (kind, start, end)."""
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m.group()) >= 18]
    spans += [("hex", *m.span()) for m in HEX.finditer(text) if len(m.group()) >= 16] if _has_hex(text) else []
    if "PRIVATE KEY-----" in text:
        spans += [("pem", *m.span()) for m in PEM.finditer(text) if is_pem_body(m.group(1))]
    spans += [("token", *m.span()) for m in SIGNED.finditer(text) if is_signed_token(*m.groups())]
    for run, decode in ((BASE64_RUN, _base64), (HEX_RUN, _unhex)):
        for m in run.finditer(text):
            kind = key_kind(decode(m.group()))
            if kind:
                spans.append((kind, *m.span()))
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_SIXTEEN_HEX = re.compile(r"[0-9a-f]{16}")


def _has_hex(text: str) -> bool:
    return _SIXTEEN_HEX.search(text) is not None


def key_kind(raw: bytes | None) -> str | None:
    """``der`` or ``ssh`` if the bytes are a whole private key of that encoding."""
    if not raw:
        return None
    if raw.startswith(SSH_MAGIC):
        return "ssh" if _is_ssh_key(raw) else None
    return "der" if raw[0] == SEQUENCE and _is_private_der(raw) else None


def _tlv(raw: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the value at ``at``; None if its length does not fit before ``end``."""
    if at + 2 > end:
        return None
    tag, length, at = raw[at], raw[at + 1], at + 2
    if length & 0x80:
        size = length & 0x7F
        if not 1 <= size <= 4 or at + size > end:
            return None
        length, at = int.from_bytes(raw[at : at + size], "big"), at + size
    return (tag, at, at + length) if at + length <= end else None


def _children(raw: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    found = []
    while at < end:
        item = _tlv(raw, at, end)
        if item is None:
            return None
        found.append(item)
        at = item[2]
    return found


def _is_private_der(raw: bytes) -> bool:
    outer = _tlv(raw, 0, len(raw))
    if outer is None or outer[2] != len(raw):
        return False
    parts = _children(raw, outer[1], outer[2])
    if not parts or len(parts) < 2:
        return False
    tags = [tag for tag, _, _ in parts]
    if tags[0] == SEQUENCE and tags[1:] == [OCTET_STRING]:  # encrypted: algorithm, ciphertext
        inner = _children(raw, *parts[0][1:])
        return bool(inner) and inner[0][0] == OBJECT_ID
    if tags[0] != INTEGER or parts[0][2] - parts[0][1] != 1 or raw[parts[0][1]] > 1:
        return False
    if tags[1:3] == [SEQUENCE, OCTET_STRING]:  # version, algorithm, wrapped key
        inner = _children(raw, *parts[1][1:])
        return bool(inner) and inner[0][0] == OBJECT_ID and parts[2][2] > parts[2][1]
    if tags[1] == OCTET_STRING:  # version 1, scalar of an elliptic curve
        return raw[parts[0][1]] == 1 and 20 <= parts[1][2] - parts[1][1] <= 66
    return len(tags) >= 6 and all(tag == INTEGER for tag in tags)  # version, then the numbers of the key


def _is_ssh_key(raw: bytes) -> bool:
    at = len(SSH_MAGIC)

    def field(at: int) -> int | None:
        if at + 4 > len(raw):
            return None
        end = at + 4 + int.from_bytes(raw[at : at + 4], "big")
        return end if end <= len(raw) else None

    for _ in range(3):  # cipher, key derivation, its options
        at = field(at)
        if at is None:
            return False
    if at + 4 > len(raw):
        return False
    keys, at = int.from_bytes(raw[at : at + 4], "big"), at + 4
    if not 1 <= keys <= 16:
        return False
    for _ in range(keys + 1):  # public keys, then the private list
        at = field(at)
        if at is None:
            return False
    return at == len(raw)


def is_pem_body(body: str) -> bool:
    """Whether the text between the marks of a PEM block is a private key, after header lines if there are any.

    Line breaks may be escaped. Under the headers of an encrypted key the bytes have no structure of their own; they
    must be whole blocks of the cipher, whose size the length of its initial vector tells, where it works in blocks.
    """
    body = SLASH.sub("/", BREAK.sub("\n", body))
    encrypted = ENCRYPTED.match(body)
    rest = body[HEADERS.match(body, encrypted.end() if encrypted else 0).end() :]
    raw = _base64(re.sub(r"\s", "", rest))
    if not encrypted:
        return key_kind(raw) is not None
    block = len(encrypted.group(2)) // 2 if encrypted.group(1).upper().endswith("-CBC") else 1
    return bool(raw) and len(raw) % block == 0


def is_signed_token(header: str, payload: str, signature: str) -> bool:
    """Whether the segments are a JSON header that names its algorithm, a JSON payload and a fitting signature."""
    if not header.startswith("ey"):
        return False
    head, body = _json(header), _json(payload)
    if not isinstance(head, dict) or not isinstance(head.get("alg"), str) or not isinstance(body, dict):
        return False
    return bool(signature) != (head["alg"].lower() == "none")


def _json(segment: str):
    raw = _base64(segment)
    try:
        return json.loads(raw) if raw else None
    except (ValueError, RecursionError):
        return None


def _base64(run: str) -> bytes | None:
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _unhex(run: str) -> bytes | None:
    return bytes.fromhex(run)


def _scan(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [
            [{"kind": k, "start": a, "end": b} for k, a, b in find(text.as_py() or "")] for text in batch.column(1)
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(SPAN))], names=["doc_id", "spans"])


def _redact(mark: str, batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        lengths = batch.schema.get_field_index("n_chars")
        before = batch.column(at).to_pylist()
        after = [_without(text, mark) if text else text for text in before]
        columns = list(batch.columns)
        columns[at] = pa.array(after, columns[at].type)
        if lengths >= 0:
            counts = columns[lengths].to_pylist()
            columns[lengths] = pa.array(
                [n if a == b else len(b) for n, a, b in zip(counts, before, after)], columns[lengths].type
            )
        yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def _without(text: str, mark: str) -> str:
    out, at = [], 0
    for _, start, end in find(text):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def digests(scanned: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of their spans and all spans as text, from rows of ``scan``."""

    def joined(spans):
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
            ),
            ",",
        )

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = of(*BASE_KINDS)
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS]
    return scanned.select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
