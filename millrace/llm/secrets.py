"""Secrets in texts, confirmed by their structure.

Base findings come from three patterns.  The operator adds what *decodes* into
a key or a token.  Candidates are whole runs: of base64 or base64url, also
wrapped over lines or over written ``\\n``; of hex, also with colons and
wrapped; of PEM armour, also with header lines; and of dotted parts.  A run is
decoded once and its bytes are tried as DER whose nested lengths fit exactly,
as an OpenSSH or public key blob whose inner lengths fit exactly, as a signed
token whose header is JSON that names an algorithm, and as a PEM text, whose
body is decoded once more.  A base64 run that does not parse is tried again
behind each ``/`` where a key's first bytes stand and declare just the length
that is left.  An encrypted PEM body counts when its header names cipher and
vector and the body is whole blocks.  What does not parse is not reported.

The work grows with a text's length: runs are found from left to right, none
overlap, and each is decoded a fixed number of times (and once for each place
behind a ``/`` that declares just the right length).  Null and empty texts have
no spans.  Rows are scanned one by one; a null ``doc_id`` stays null; other
columns are not looked at.
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

from millrace.llm.common import by_batch, raw

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "pem", "der", "openssh", "token")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a run of fewer is no match anywhere inside
_RUN = re.compile(r"[A-Za-z0-9+/_-]{24,}={0,2}")
_PART = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_BREAK = re.compile(r"(?:\\r)?\\n|\r?\n")
_HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{32,}|[0-9A-Fa-f]{2}(?::(?:(?:\\r)?\\n|\r?\n)?[ \t]*[0-9A-Fa-f]{2}){15,})(?![0-9A-Fa-f])")
_HEX_SIGNS = re.compile(r"\\[rn]|[^0-9A-Fa-f]")
_MARK = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,64})-----")
_HEADER = re.compile(r"[A-Za-z][A-Za-z0-9-]*:.*")
_CIPHER = re.compile(r"DEK-Info:\s*[A-Z0-9-]+,(?:[0-9A-Fa-f]{16}){1,2}\s*$", re.M)
_DOTTED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_.-]*")
_LEAST_HEADER = 15  # signs of {"alg":"x"}
# How encoded keys begin: a DER sequence, a length of 7 or 11 and "ssh-" or
# the like, "openssh-key-v1".
_KEY_STARTS = re.compile(r"/(?=M[A-P]|AAAA|b3BlbnNz)")

_SSH_NAMES = (b"ssh-rsa", b"ssh-ed25519", b"ssh-dss", b"ecdsa-sha2-nistp256", b"ecdsa-sha2-nistp384", b"ecdsa-sha2-nistp521")


def _items(data: bytes, depth: int = 0) -> int:
    """Elements in DER data, nested ones included; -1 where lengths do not fit."""
    at, found = 0, 0
    while at < len(data):
        if at + 2 > len(data) or depth > 16:
            return -1
        kind, length = data[at], data[at + 1]
        at += 2
        if length & 0x80:
            count = length & 0x7F
            if not 1 <= count <= 4 or at + count > len(data):
                return -1
            length, at = int.from_bytes(data[at : at + count], "big"), at + count
        if at + length > len(data):
            return -1
        found += 1
        if kind & 0x20:
            inner = _items(data[at : at + length], depth + 1)
            if inner < 0:
                return -1
            found += inner
        elif kind & 0x1F not in (1, 2, 3, 4, 5, 6, 10, 12, 19, 22, 23, 24) and kind < 0x80:
            return -1
        at += length
    return found


def is_der_key(data: bytes) -> bool:
    """One DER sequence that fills the data and starts with an integer or another sequence."""
    if len(data) < 16 or data[0] != 0x30:
        return False
    at = 2 if data[1] < 0x80 else 2 + (data[1] & 0x7F)
    length = data[1] if data[1] < 0x80 else int.from_bytes(data[2:at], "big")
    return at + length == len(data) and data[at : at + 1] in (b"\x02", b"\x30") and _items(data) >= 3


def is_ssh_blob(data: bytes | memoryview) -> bool:
    """Length-prefixed fields that fill the data, the first a known key type."""
    if bytes(data[:15]) == b"openssh-key-v1\0":
        at, fields = 15, 0
        while at + 4 <= len(data) and fields < 3:
            at, fields = at + 4 + int.from_bytes(data[at : at + 4], "big"), fields + 1
        return fields == 3 and at + 4 <= len(data) and int.from_bytes(data[at : at + 4], "big") >= 1
    first = int.from_bytes(data[:4], "big")
    if first > 32 or bytes(data[4 : 4 + first]) not in _SSH_NAMES:
        return False
    at, fields = 4 + first, 1
    while at + 4 <= len(data):
        at, fields = at + 4 + int.from_bytes(data[at : at + 4], "big"), fields + 1
    return at == len(data) and fields >= 2


def decode64(text: str) -> bytes | None:
    text = re.sub(r"\s+", "", text).replace("-", "+").replace("_", "/").rstrip("=")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def is_token(text: str) -> bool:
    """A signed token: its header is a JSON object that names an algorithm."""
    header = decode64(text.split(".")[0])
    try:
        found = json.loads(header) if header else None
    except (ValueError, RecursionError):
        return False
    return isinstance(found, dict) and isinstance(found.get("alg"), str)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Leftmost matches that do not overlap, per kind; short ones go."""
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found + [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]


def _kind_of(data: bytes | None, deep: bool = True) -> str | None:
    """What decoded bytes are, if they are a secret."""
    if not data:
        return None
    if is_der_key(data):
        return "der"
    if is_ssh_blob(data):
        return "openssh"
    if deep and data.startswith(b"-----BEGIN "):
        found = list(_armoured(data.decode("latin-1")))
        return "pem" if found else None
    if data.startswith(b"eyJ") and _DOTTED.fullmatch(text := data.decode("latin-1")) and is_token(text):
        return "token"
    return None


def _armoured(text: str) -> Iterator[tuple[int, int]]:
    """PEM texts whose body is a key: a mark, a body, the mark's own end."""
    opened = None
    for mark in _MARK.finditer(text):
        if mark[1] == "BEGIN":
            opened = mark
        elif opened is not None and opened[2] == mark[2]:
            if _is_body(text[opened.end() : mark.start()]):
                yield opened.start(), mark.end()
            opened = None


def _is_body(inside: str) -> bool:
    lines = [x.strip() for x in _BREAK.split(inside)]
    headers = [x for x in lines if _HEADER.fullmatch(x)]
    body = "".join(x for x in lines if x and not _HEADER.fullmatch(x))
    data = decode64(body) if body else None
    if not data:
        return False
    if headers and _CIPHER.search("\n".join(headers)):
        return len(data) % 8 == 0
    return is_der_key(data) or is_ssh_blob(data)


def _block(text: str, first: re.Match) -> list[tuple[int, int]]:
    """The lines of a wrapped run: full ones as long as the first, then a last one."""
    spans, width = [first.span()], first.end() - first.start()
    while text[spans[-1][1] - 1] != "=" and (gap := _BREAK.match(text, spans[-1][1])):
        at = gap.end()
        while at < len(text) and text[at] in " \t":
            at += 1
        part = _PART.match(text, at)
        if not part or part.end() - at > width:
            break
        spans.append(part.span())
        if part.end() - at < width:
            break
    return spans


def _declared(head: bytes | memoryview) -> int | None:
    """How many bytes a DER sequence takes, from its first ones."""
    if len(head) < 6 or head[0] != 0x30:
        return None
    if head[1] < 0x80:
        return 2 + head[1]
    count = head[1] & 0x7F
    return 2 + count + int.from_bytes(head[2 : 2 + count], "big") if 1 <= count <= 4 else None


def _behind_slash(run: str) -> Iterator[tuple[int, bytes]]:
    """Places behind a slash, and the bytes from there, where a key of just that
    length may stand.  The run is decoded once for each of the four alignments."""
    signs = run.rstrip("=")
    decoded: dict[int, memoryview] = {}
    for slash in _KEY_STARTS.finditer(run):
        at = slash.end()
        if (len(signs) - at) % 4 == 1:
            continue
        if at % 4 not in decoded:
            decoded[at % 4] = memoryview(decode64(signs[at % 4 :]) or b"")
        rest = decoded[at % 4][at // 4 * 3 :]
        if _declared(rest[:6]) == len(rest) or is_ssh_blob(rest):
            yield at, bytes(rest)


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    """Candidates that decode into a key or a signed token."""
    found = [(start, end, "pem") for start, end in _armoured(text)] if "-----BEGIN " in text else []
    armour = [(s, e) for s, e, _ in found]
    last = 0
    for run in _RUN.finditer(text):
        if run.start() < last:
            continue
        while armour and armour[0][1] <= run.start():
            armour.pop(0)
        if armour and armour[0][0] <= run.start():
            continue  # the body of an armoured key
        lines = _block(text, run)
        whole = "".join(text[s:e] for s, e in lines)
        tries = [(lines[0][0], lines[-1][1], whole)]
        if len(lines) > 1:
            tries += [(s, e, text[s:e]) for s, e in lines]
        last = lines[-1][1]
        for start, end, some in tries:
            kind = _kind_of(decode64(some))
            if kind is None and end - start == len(some):
                for at, rest in _behind_slash(some):
                    if kind := _kind_of(rest):
                        start += at
                        break
            if kind:
                found.append((start, end, kind))
                if len(some) == len(whole):
                    break
    for run in _HEX_RUN.finditer(text):
        digits = _HEX_SIGNS.sub("", run[0])
        if len(digits) % 2 == 0 and (kind := _kind_of(bytes.fromhex(digits))):
            found.append((run.start(), run.end(), kind))
    if "eyJ" in text:
        for run in _DOTTED.finditer(text):
            found += _tokens(run)
    return sorted(set(found))


def _tokens(run: re.Match) -> Iterator[tuple[int, int, str]]:
    """Signed tokens among dotted parts: three in a row, the first a header.

    The header starts at the part's first ``eyJ``, or at its last one.
    """
    parts, at = run[0].split("."), run.start()
    skip = 0
    for i, part in enumerate(parts):
        if not skip and i + 2 < len(parts) and "eyJ" in part and parts[i + 1]:
            signature = re.match(r"[A-Za-z0-9_-]*", parts[i + 2])[0]
            for start in dict.fromkeys((part.find("eyJ"), part.rfind("eyJ"))):
                if len(part) - start >= _LEAST_HEADER and is_token(part[start:]):
                    yield at + start, at + len(part) + 1 + len(parts[i + 1]) + 1 + len(signature), "token"
                    skip = 3
                    break
        skip = max(0, skip - 1)
        at += len(part) + 1


def find_secrets(documents: DataFrame) -> DataFrame:
    """Per document all spans: ``(kind, start, end)``, by start, then kind.

    Offsets count code points and the end is exclusive.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for data in raw(batch.column(1)):
            text = data.decode("utf-8", "replace") if data else ""
            spans = base_spans(text) + confirmed_spans(text)
            out.append([{"kind": k, "start": s, "end": e} for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))])
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(out, pa.list_(span))], ["doc_id", "spans"])

    return by_batch(documents.select("doc_id", "text"), work, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def digest(spans: list[tuple[int, int, str]]) -> str:
    """The digest of base spans, as the query returns it; for tests."""
    ordered = sorted((x for x in spans if x[2] in BASE), key=lambda x: (x[0], KINDS.index(x[2])))
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in ordered).encode()).hexdigest()
