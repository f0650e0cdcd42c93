"""Secret scans with structural confirmation.

Patterns alone report three base kinds: ``assign``, ``access`` and ``hex``. The
method adds candidates that a structure confirms: base64 or hex is decoded, key
encodings are parsed down to their nested lengths, and the header and payload of
signed tokens are read as JSON. Kinds added: ``pem`` (an armoured private key),
``jwt`` (a signed token), ``key`` (a bare private key in base64) and ``hexkey``
(the same in hex).
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
from pyspark.sql import functions as F

from .common import lean, ship

KINDS = ("assign", "access", "hex", "pem", "jwt", "key", "hexkey")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # greedy from its first character: the whole run
_ARMOUR = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
# The least are the 21 bytes of a SEC1 key on the smallest standard curve (112 bits).
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{28,}={0,2}")
_LONG_HEX = re.compile(r"[0-9A-Fa-f]{42,}")
_BASE64_LINES = re.compile(r"[A-Za-z0-9+/_-]{8,}(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]+)+={0,2}")
_HEX_LINES = re.compile(r"[0-9A-Fa-f]{12,}(?:[ \t]*\r?\n[ \t]*[0-9A-Fa-f]+)+")
_OPENSSH = b"openssh-key-v1\0"


def decode_base64(text: str) -> bytes | None:
    """Standard or URL-safe base64, padded or not; None if it is neither."""
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the content of the DER element at ``at``."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n >= 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or at + k > end or data[at] == 0:
            return None
        n, at = int.from_bytes(data[at : at + k], "big"), at + k
        if n < 0x80:
            return None
    return (tag, at, at + n) if at + n <= end else None


def _children(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``start`` to ``end`` exactly."""
    out = []
    while start < end:
        x = _element(data, start, end)
        if x is None or len(out) > 64:
            return None
        out.append(x)
        start = x[2]
    return out


def is_private_key(data: bytes) -> bool:
    """Whether the bytes are a private key: nested lengths must fit to the byte.

    PKCS#1 (nine integers), PKCS#8 (version, algorithm, octet string), SEC1 (version
    1, octet string), DSA (six integers) or the OpenSSH container.
    """
    if data.startswith(_OPENSSH):
        at = len(_OPENSSH)
        for _ in range(3):  # cipher, key derivation, its options
            n = int.from_bytes(data[at : at + 4], "big")
            at += 4 + n
            if at > len(data):
                return False
        return int.from_bytes(data[at : at + 4], "big") >= 1
    top = _element(data, 0, len(data))
    if top is None or top[0] != 0x30 or top[2] != len(data):
        return False
    parts = _children(data, top[1], top[2])
    if not parts or len(parts) < 2 or parts[0][0] != 0x02 or parts[0][2] - parts[0][1] != 1:
        return False
    tags, version = [p[0] for p in parts], data[parts[0][1]]
    if version in (0, 1) and tags == [0x02] * 9 or version == 0 and tags == [0x02] * 6:
        return True
    if version in (0, 1) and tags[1] == 0x30 and len(tags) >= 3 and tags[2] == 0x04:
        inner = _children(data, parts[1][1], parts[1][2])
        return bool(inner) and inner[0][0] == 0x06
    return version == 1 and tags[1] == 0x04 and all(t in (0xA0, 0xA1) for t in tags[2:])


def wrapped_keys(text: str, lines: re.Pattern, decode, size) -> list[tuple[int, int]]:
    """Spans of private keys whose encoding goes on over lines that follow each other.

    The outer length of a key says how many characters it takes (``size`` of its
    bytes), so other lines may stand before and after it. An OpenSSH container has no
    outer length: it takes the lines as wide as its first and the one after them.
    """
    out = []
    for m in lines.finditer(text):
        parts = [(m.start() + x.start(), m.start() + x.end()) for x in re.finditer(r"[^\s=]+", m[0])]
        total = [0]
        for a, b in parts:
            total.append(total[-1] + b - a)
        after = {n: i for i, n in enumerate(total)}
        i = 0
        while i < len(parts):
            a, b = parts[i]
            head = decode(text[a : a + (b - a) // 4 * 4][:80]) or b""
            stop = None
            if len(head) >= 6 and head[0] == 0x30:
                k = head[1] & 0x7F if head[1] & 0x80 else 0
                n = 2 + k + (int.from_bytes(head[2 : 2 + k], "big") if k else head[1])
                stop = after.get(total[i] + size(n)) if k <= 4 else None
            elif head.startswith(_OPENSSH[:9]):
                stop = i + 1
                while stop < len(parts) and parts[stop - 1][1] - parts[stop - 1][0] == b - a >= parts[stop][1] - parts[stop][0]:
                    stop += 1
            if stop and stop > i + 1 and is_private_key(decode("".join(text[x:y] for x, y in parts[i:stop])) or b""):
                end = parts[stop - 1][1]
                out.append((a, end + len(re.match("={0,2}", text[end : end + 2])[0])))
                i = stop
            else:
                i += 1
    return out


def is_signed_token(header: str, payload: str) -> bool:
    """Whether both parts are JSON objects and the header names an algorithm."""
    try:
        head, body = (json.loads(decode_base64(x) or b"") for x in (header, payload))
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(body, dict)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The three base kinds: leftmost non-overlapping per kind, short ones dropped."""
    out = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return out + [("hex", *m.span()) for m in _HEX.finditer(text)]


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    """What a structure confirms; a key inside armour is reported once, as ``pem``."""
    out = []
    if "-----BEGIN " in text:
        for m in _ARMOUR.finditer(text):
            close = f"-----END {m[1]}-----"
            end = text.find(close, m.end())
            if end >= 0:
                body = [x for x in text[m.end() : end].split("\n") if ":" not in x]
                raw = decode_base64("".join("".join(body).split()))
                encrypted = "ENCRYPTED" in m[1] or "ENCRYPTED" in text[m.end() : m.end() + 80]
                if raw and (is_private_key(raw) or encrypted and len(raw) >= 32):
                    out.append(("pem", m.start(), end + len(close)))
    if "eyJ" in text:
        out += [("jwt", *m.span()) for m in _TOKEN.finditer(text) if is_signed_token(m[1], m[2])]
    inside = [(a, b) for _, a, b in out]
    for kind, pattern, lines, decode, size in (("key", _BASE64, _BASE64_LINES, decode_base64, lambda n: -(-4 * n // 3)), ("hexkey", _LONG_HEX, _HEX_LINES, lambda x: bytes.fromhex(x[: len(x) // 2 * 2]), lambda n: 2 * n)):
        wrapped = [(a, b) for a, b in wrapped_keys(text, lines, decode, size) if not any(x <= a < y for x, y in inside)]
        out += [(kind, a, b) for a, b in wrapped]
        for m in pattern.finditer(text):
            raw = decode(m[0])
            if raw and is_private_key(raw) and not any(a <= m.start() < b for a, b in inside + wrapped):
                out.append((kind, *m.span()))
    return out


def listed(spans: list[tuple[str, int, int]]) -> str:
    spans = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scan every whole text; one row per input row.

    Null texts are empty (no spans); null ids pass through; repeated rows give
    repeated results; an empty table gives no rows; other columns are ignored.
    Offsets are code points, ends exclusive. Returns doc_id, n_assign, n_access,
    n_hex, n_confirmed, base_sha256, spans.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for text in batch.column(1):
                t = text.as_py() or ""
                base, more = base_spans(t), confirmed_spans(t)
                kinds = [k for k, _, _ in base]
                for col, v in zip(cols, (kinds.count("assign"), kinds.count("access"), kinds.count("hex"), len(more), hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + more)), strict=True):
                    col.append(v)
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], ["doc_id", "n_assign", "n_access", "n_hex", "n_confirmed", "base_sha256", "spans"])

    ship(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(lean(run), "doc_id long, n_assign long, n_access long, n_hex long, n_confirmed long, base_sha256 string, spans string")
