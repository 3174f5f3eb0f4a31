"""Secret scans with structural confirmation.

A candidate is reported only if its structure holds up:
* signed token: three base64url parts whose first decodes to a JSON object with an "alg" text, whose second decodes to a
  JSON object, and whose third is empty only for alg "none";
* key: base64 between key markers, whose lines may be escaped, quoted or joined strings; or a bare base64 or hex run, on
  one line or on several of which the first has 40 characters or more; that decodes to DER whose nested lengths fill
  the outer SEQUENCE exactly and whose members are those of a PKCS#1, PKCS#8, SEC1 or encrypted private key; or to an
  openssh-key-v1 container whose length-prefixed fields fill it;
* access key id: a four-letter prefix and 16 base32 characters, which decode to 10 bytes (80 bits) without padding;
* assigned secret: a hex or base64 run assigned to a name such as token, password or api_key that decodes to at least
  MIN_BYTES bytes that are not text and not a run of few values.
Spark's regular expressions pick the documents that hold a candidate; Python parses only those.

Defined cases
* A null or empty text reports nothing. Findings are in order of position; a place is reported once, under the first
  kind above that confirms it. Repeated rows report repeatedly. A null doc_id reports under null.
* Texts of any length are searched whole, in time that grows with the length; extra columns are ignored; an empty table
  gives an empty result.
* What counts as structure is bounded as in the encodings: DER that nests deeper than 12 levels (no key format passes 6)
  and key markers whose label has over 40 characters before PRIVATE KEY (the longest in use has 10) are no keys.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_BYTES = 8
JWT = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
MARK = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")
#: Where a run may begin: the letter of an escaped line break is no part of it.
FIRST = r"(?:(?<![A-Za-z0-9+/_-])(?!(?<=\\)[nrt])|(?<=\\[nrt]))"
RUN = re.compile(FIRST + r"[A-Za-z0-9+/]{40,}={0,2}")
#: A line break, real or escaped, with the quote marks and signs around it that join or quote lines.
BREAK = r"(?:[\"'`]?[ \t]*+[+,\\]?[ \t]*+\r?\n|(?:\\++[nr])++[\"'`]?[ \t]*+[+,\\]?[ \t]*+(?:\r?\n)?)[ \t>#*|\"'`]*+"
WRAPPED = re.compile(FIRST + r"[A-Za-z0-9+/]{40,}+(?:" + BREAK + r"[A-Za-z0-9+/]++)+")
LINE = re.compile(r"([A-Za-z0-9+/]+)(?:" + BREAK + r"|\Z)")
KEY_ID = re.compile(r"(?<![A-Z0-9])((?:AKIA|ASIA|ABIA|ACCA)[A-Z2-7]{16})(?![A-Z0-9])")
ASSIGNED = re.compile(r"(?i)(?<![a-z0-9])(token|password|passwd|pwd|secret|api[_-]?key|access[_-]?key|private[_-]?key)[\"']?\s{0,3}(?::=|=>|[:=])\s{0,3}[\"']?([A-Za-z0-9+/_-]{12,}={0,2})")
#: What Java looks for: a superset of the above.
CANDIDATE = (
    r"[A-Za-z0-9_-]{8}\.[A-Za-z0-9_-]{2,}\.|PRIVATE KEY-----|[A-Za-z0-9+/]{40}|(?:AKIA|ASIA|ABIA|ACCA)[A-Z2-7]{16}"
    r"|(?i:token|password|passwd|pwd|secret|api[_-]?key|access[_-]?key|private[_-]?key)[\"']?\s{0,3}(?::=|=>|[:=])"
)


def der(data: bytes, at: int = 0, end: int | None = None, depth: int = 0) -> list[tuple[int, bytes, list]] | None:
    """The (tag, content, members) tree of DER elements that fill data[at:end] exactly, or None."""
    end = len(data) if end is None else end
    out = []
    while at < end:
        if end - at < 2:
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > end or data[at] == 0:
                return None
            size = int.from_bytes(data[at : at + n], "big")
            if size < 0x80:
                return None
            at += n
        if at + size > end:
            return None
        members: list = []
        if tag & 0x20:
            if depth > 12 or (inner := der(data, at, at + size, depth + 1)) is None:
                return None
            members = inner
        out.append((tag, data[at : at + size], members))
        at += size
    return out


def key_kind(data: bytes) -> str | None:
    """Which private-key encoding data is, by its structure."""
    if data.startswith(b"openssh-key-v1\0"):
        at, fields = 15, 0
        while at < len(data):
            if fields == 3:  # the number of keys
                at += 4
            if at + 4 > len(data):
                return None
            size = int.from_bytes(data[at : at + 4], "big")
            at += 4 + size
            fields += 1
        return "openssh_key" if at == len(data) and fields >= 5 else None
    if not data or data[0] != 0x30:
        return None
    tree = der(data)
    if not tree or len(tree) != 1:
        return None
    top = tree[0][2]
    tags = [t for t, _, _ in top]
    if tags[:3] == [0x02, 0x30, 0x04] and top[0][1] in (b"\0", b"\1") and top[1][2] and top[1][2][0][0] == 0x06:
        return "pkcs8_key"
    if tags == [0x30, 0x04] and top[0][2] and top[0][2][0][0] == 0x06:
        return "encrypted_key"
    if len(tags) >= 9 and set(tags[:9]) == {0x02} and top[0][1] in (b"\0", b"\1"):
        return "pkcs1_key"
    if tags[:2] == [0x02, 0x04] and top[0][1] == b"\1" and set(tags[2:]) <= {0xA0, 0xA1}:
        return "sec1_key"
    if len(tags) == 6 and set(tags) == {0x02} and top[0][1] == b"\0":
        return "dsa_key"
    return None


def decode64(text: str) -> bytes | None:
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json(text: str) -> dict | None:
    raw = decode64(text)
    try:
        value = json.loads(raw) if raw else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def token_kind(head: str, body: str, sign: str) -> str | None:
    header = _json(head)
    if header is None or not isinstance(header.get("alg"), str) or _json(body) is None:
        return None
    if not sign:
        return "unsigned_token" if header["alg"].lower() == "none" else None
    return "signed_token" if decode64(sign) else None


def opaque(value: str) -> bool:
    """Whether a hex or base64 value decodes to enough bytes that look drawn at random rather than written."""
    if re.fullmatch(r"(?:[0-9a-f]{2})+|(?:[0-9A-F]{2})+", value):
        raw = bytes.fromhex(value)
    elif re.search(r"\d", value) and re.search(r"[a-z]", value) and re.search(r"[A-Z]", value):
        raw = decode64(value)
    else:
        return False
    if raw is None or len(raw) < MIN_BYTES or len(set(raw)) < 0.6 * min(len(raw), 64):
        return False
    return sum(32 <= b < 127 or b in b"\t\r\n" for b in raw) < 0.8 * len(raw)


def marked(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, text between) of each key marker and the next one, if that is its end."""
    begin = None
    for m in MARK.finditer(text):
        if m[1] == "END" and begin and begin[2] == m[2]:
            yield begin.start(), m.end(), text[begin.end() : m.start()]
        begin = m if m[1] == "BEGIN" else None


def plain(body: str) -> str:
    """Text between key markers without escapes, joined strings and the signs that quote a line."""
    body = re.sub(r"\\+u([0-9A-Fa-f]{4})", lambda m: chr(int(m[1], 16)), body)
    body = re.sub(r"\\+([rnt/])", lambda m: {"r": "\n", "n": "\n", "t": " ", "/": "/"}[m[1]], body)
    body = re.sub(r"([\"'`])[ \t]*+\+?\s*+\+?[ \t]*+(?=[\"'`])", "\n", body)
    return re.sub(r"(?m)^[ \t]*(?:[>#*|\"'`]+[ \t]*)+|^[ \t]*//+[ \t]+", "", body)


def key_size(data: bytes) -> int | None:
    """The bytes that a key at the start of data says it has."""
    if data.startswith(b"openssh-key-v1\0"):
        at, left = 15, 3
        while left:
            at += 4 + int.from_bytes(data[at : at + 4], "big")
            left -= 1
            if at > len(data):
                return None
        left = int.from_bytes(data[at : at + 4], "big") + 1
        at += 4
        while left and at < len(data):
            at += 4 + int.from_bytes(data[at : at + 4], "big")
            left -= 1
        return None if left else at
    if len(data) < 6 or data[0] != 0x30:
        return None
    n = data[1] & 0x7F if data[1] & 0x80 else 0
    if n > 4 or data[1] == 0x80:
        return None
    return 2 + n + (int.from_bytes(data[2 : 2 + n], "big") if n else data[1])


def wrapped_keys(text: str, start: int, end: int) -> Iterator[tuple[int, int, str]]:
    """(start, end, kind) of the keys in text[start:end], lines of base64 or hex: each begins with a line, and is as long
    as its own lengths say."""
    lines = [m.span(1) for m in LINE.finditer(text, start, end)]
    joined = "".join(text[a:b] for a, b in lines)
    begins = list(accumulate((b - a for a, b in lines), initial=0))
    free = 0
    for (a, _), at in zip(lines, begins):
        if at < free:
            continue
        for mark, head, decode, size_of in (
            ("M", 8, decode64, lambda n: (4 * n + 2) // 3),
            ("b3BlbnNzaC1rZXktdjEA", (len(joined) - at) // 4 * 4, decode64, lambda n: (4 * n + 2) // 3),
            ("30", 12, unhex, lambda n: 2 * n),
        ):
            if not joined.startswith(mark, at):
                continue
            size = key_size(decode(joined[at : at + head]) or b"")
            stop = at + size_of(size) if size else len(joined) + 1
            if stop > len(joined) or not (kind := key_kind(decode(joined[at:stop]) or b"")):
                continue
            i = bisect_left(begins, stop) - 1
            last = lines[i][0] + stop - begins[i]
            if last == lines[i][1]:
                pad = re.compile("={0,2}").match(text, last).end()
                yield a, pad, kind
                free = stop
                break


def unhex(text: str) -> bytes | None:
    return bytes.fromhex(text) if re.fullmatch(r"(?:[0-9a-fA-F]{2})+", text) else None


def scan(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every confirmed secret, in order."""
    found: list[tuple[int, int, str]] = []  # in order, none over another

    def add(start: int, end: int, kind: str | None) -> None:
        if kind:
            i = bisect_left(found, (start,))
            if (not i or found[i - 1][1] <= start) and (i == len(found) or found[i][0] >= end):
                found.insert(i, (start, end, kind))

    for m in JWT.finditer(text):
        add(m.start(), m.end(), token_kind(*m.groups()))
    for start, end, inner in marked(text):
        body = plain(inner)
        bare = re.sub(r"(?m)^[A-Za-z-]+:.*$", "", body)
        raw = decode64(re.sub(r"[\s\"'`\\,]", "", bare))
        wrapped = bare != body and raw is not None and len(raw) >= 16 and len(raw) % 8 == 0
        add(start, end, "encrypted_key" if wrapped else key_kind(raw or b""))
    for m in WRAPPED.finditer(text):
        for start, end, kind in wrapped_keys(text, m.start(), m.end()):
            add(start, end, kind)
    for m in RUN.finditer(text):
        run = m[0].rstrip("=")
        raw = bytes.fromhex(run) if re.fullmatch(r"(?:[0-9a-fA-F]{2})+", run) else decode64(m[0])
        add(m.start(), m.end(), key_kind(raw or b""))
    for m in KEY_ID.finditer(text):
        add(m.start(), m.end(), "access_key_id" if len(base64.b32decode(m[1][4:])) == 10 else None)
    for m in ASSIGNED.finditer(text):
        add(m.start(2), m.end(2), "assigned_secret" if opaque(m[2]) else None)
    return found


def secret_scan(docs: DataFrame) -> DataFrame:
    """(doc_id, start, length, kind), start counted in characters from 0, for every confirmed secret."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, start, length, kinds = [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                for s, e, k in scan(text):
                    rows.append(i)
                    start.append(s)
                    length.append(e - s)
                    kinds.append(k)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(kinds, pa.string())], names=["doc_id", "start", "length", "kind"])

    held = docs.select(F.col("doc_id").alias("d"), F.col("text").alias("t")).where(F.col("t").rlike(CANDIDATE))
    return held.mapInArrow(run, f"doc_id {kind}, start long, length long, kind string")
