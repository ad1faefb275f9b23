"""Secret scan: patterns, and structural confirmation of encoded candidates.

Three plain patterns are reported by their form. Base64 and hex candidates are reported only once they decode to
something that holds together: a signed token whose header and payload are JSON and whose signature has its algorithm's
length, a DER private key whose nested lengths add up, an OpenSSH key whose length-prefixed fields fill it, or a PEM
block of either. Every base64 or hex run is a candidate, also across wrapped or escaped line ends: a key may start anywhere
in it and ends at its end or at that of a line. What decodes to text or PEM is searched once more in the same way.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "signed_token", "pem_key", "encoded_key", "hex_key")
#: Signature bytes by algorithm; others need 128 or more.
SIGNATURE = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132, "EdDSA": 64}

WORDS = re.compile("pass|secret|token|api", re.A)
TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])ey[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
PEM_MARK = re.compile(r"-----(BEGIN|END) ((?:[A-Z0-9]++ ?+)*+)-----")
PEM_BODY = re.compile(r"[A-Za-z0-9+/=\s:,\\-]*+")
ESCAPED = re.compile(r"\\+[rnt]|\\(?=\s)")
#: Runs of base64 (either alphabet) and of hex, with line ends (wrapped, continued or escaped) within them.
LINE_END = r"(?:[ \t]*+(?:\\?\r?\n|\\+[rn])[ \t]*+)++"
RUN = re.compile(rf"(?:\\+[rnt])*+([A-Za-z0-9+/_-]++(?:{LINE_END}[A-Za-z0-9+/_-]++)*+)={{0,2}}")
HEX_RUN = re.compile(rf"((?:30|6[fF]70|2[dD]2[dD])[0-9A-Fa-f]*+(?:{LINE_END}[0-9A-Fa-f]++)*+)")
PIECE, HEX_PIECE = (re.compile(rf"([{c}]++)(?:{LINE_END})?+") for c in ("A-Za-z0-9+/_-", "0-9A-Fa-f"))
#: How DER, OpenSSH keys and PEM start, encoded.
STARTS = re.compile("(?=M[A-P]|b3BlbnNzaC1rZXkt|LS0tLS1CRUdJTi)")
HEX_STARTS = re.compile("(?=30|6f70656e7373682d6b65792d|2d2d2d2d2d424547494e)")
#: The parsers take no key of fewer bytes.
LEAST_KEY = 23
OPENSSH = b"openssh-key-v1\0"


def unbase64(text: str) -> bytes | None:
    """Either alphabet, with or without padding; None if it isn't base64."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes, at: int = 0, end: int | None = None) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the items that fill data[at:end] exactly; None if the lengths don't add up."""
    end = len(data) if end is None else end
    out = []
    while at < end:
        if at + 2 > end:
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > end:
                return None
            size = int.from_bytes(data[at : at + n], "big")
            at += n
        if at + size > end:
            return None
        out.append((tag, at, at + size))
        at += size
    return out


def is_private_der(data: bytes) -> bool:
    """PKCS#1, PKCS#8 (plain or encrypted), SEC1 or DSA private keys, by their nested structure."""
    whole = der_items(data)
    if not whole or len(whole) != 1 or whole[0][0] != 0x30:
        return False
    inner = der_items(data, *whole[0][1:])
    if not inner:
        return False
    tags = [t for t, _, _ in inner]
    if tags[0] == 0x02 and inner[0][2] - inner[0][1] == 1:
        if set(tags) == {0x02}:
            return len(tags) >= 6 and max(e - s for _, s, e in inner) >= 16
        if tags[:3] == [0x02, 0x30, 0x04]:
            algorithm = der_items(data, *inner[1][1:])
            return bool(algorithm) and algorithm[0][0] == 0x06
        return tags[:2] == [0x02, 0x04] and inner[1][2] - inner[1][1] >= 16 and all(t & 0xE0 == 0xA0 for t in tags[2:])
    if tags == [0x30, 0x04]:
        algorithm = der_items(data, *inner[0][1:])
        return bool(algorithm) and algorithm[0][0] == 0x06 and inner[1][2] - inner[1][1] >= 32
    return False


def is_openssh(data: bytes) -> bool:
    """Magic, cipher, kdf, options, a count of keys, the public keys and the private part, each with its length."""
    if not data.startswith(OPENSSH):
        return False
    at, fields = len(OPENSSH), 0
    count = None
    while at + 4 <= len(data):
        n = int.from_bytes(data[at : at + 4], "big")
        if fields == 3 and count is None:
            count, at = n, at + 4
            continue
        at += 4 + n
        fields += 1
        if at > len(data):
            return False
    return at == len(data) and count is not None and fields == 3 + count + 1


def key_size(data: bytes) -> int | None:
    """The bytes that a key at the start of data says it has; None if it starts like none."""
    if data.startswith(OPENSSH):
        at, fields, count = len(OPENSSH), 0, None
        while at + 4 <= len(data) and (count is None or fields < 4 + count):
            n = int.from_bytes(data[at : at + 4], "big")
            if fields == 3 and count is None:
                count, at = n, at + 4
                continue
            at, fields = at + 4 + n, fields + 1
        return at
    if len(data) < 2 or data[0] != 0x30:
        return None
    n = data[1] & 0x7F
    if data[1] < 0x80:
        return 2 + n
    return 2 + n + int.from_bytes(data[2 : 2 + n], "big") if 1 <= n <= 4 else None


def is_key(data: bytes | None) -> bool:
    return bool(data) and (is_private_der(data) or is_openssh(data))


def is_signed_token(text: str) -> bool:
    head, body, sign = text.split(".")
    try:
        parts = [json.loads(unbase64(x) or b"") for x in (head, body)]
    except (ValueError, RecursionError):
        return False
    if not all(isinstance(x, dict) for x in parts) or not isinstance(parts[0].get("alg"), str):
        return False
    alg, sign = parts[0]["alg"], unbase64(sign)
    if alg.lower() == "none":
        return sign == b""
    if sign is None:
        return False
    return len(sign) == SIGNATURE[alg] if alg in SIGNATURE else len(sign) >= 128


def find_secrets(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind's index in KINDS, end), sorted; code points, end exclusive."""
    if not text:
        return []
    out = []
    if WORDS.search(text.lower()):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "." in text and "ey" in text:
        out += [(m.start(), 3, m.end()) for m in TOKEN.finditer(text) if is_signed_token(m[0])]
    return sorted(out + find_keys(text))


def find_pem(text: str) -> list[tuple[int, int, int]]:
    """Blocks from a BEGIN mark to the next mark, if that is its END: every part of the text is read once."""
    out, begin = [], None
    if "-----BEGIN" not in text:
        return out
    for m in PEM_MARK.finditer(text):
        if m[1] == "BEGIN":
            begin = m if m[2].endswith("PRIVATE KEY") else None
            continue
        if begin is not None and begin[2] == m[2] and PEM_BODY.match(text, begin.end(), m.start()).end() == m.start():
            inner = text[begin.end() : m.start()]
            body = re.sub(r"(?m)^[A-Za-z-]+:.*$", "", ESCAPED.sub("\n", inner))
            if is_key(unbase64(re.sub(r"\s", "", body))) or "Proc-Type" in inner and len(unbase64(re.sub(r"\s", "", body)) or b"") >= 64:
                out.append((begin.start(), 4, m.end()))
        begin = None
    return out


def as_text(data: bytes | None) -> str | None:
    if not data or not all(32 <= x < 127 or x in b"\t\r\n" for x in data[:16]):
        return None
    try:
        return data.decode()
    except UnicodeDecodeError:
        return None


def find_keys(text: str, deeper: bool = True) -> list[tuple[int, int, int]]:
    """Keys by their structure: PEM, and encoded runs outside of it. With `deeper`, text that runs decode to is searched too."""
    out = find_pem(text)
    blocks = [(a, b) for a, _, b in out]
    for m in RUN.finditer(text):
        if m.end() - m.start() >= LEAST_KEY * 4 // 3:
            out += [(a, 5, b) for a, b in keys_of_run(text, m, PIECE, False, deeper)]
    for m in HEX_RUN.finditer(text):
        if m.end() - m.start() >= 2 * LEAST_KEY:
            out += [(a, 6, b) for a, b in keys_of_run(text, m, HEX_PIECE, True, deeper)]
    return [x for x in out if x[1] == 4 or not any(a <= x[0] and x[2] <= b for a, b in blocks)]


def keys_of_run(text: str, m: re.Match, piece: re.Pattern, in_hex: bool, deeper: bool) -> list[tuple[int, int]]:
    """(start, end) in text of the keys in a run."""
    at, starts, pieces = m.start(1), [], []
    while at < m.end(1):
        found = piece.match(text, at)
        starts.append(at)
        pieces.append(found[1])
        at = found.end()
    code = "".join(pieces)
    code = code.lower() if in_hex else code.replace("-", "+").replace("_", "/")
    ends = list(accumulate(map(len, pieces)))
    edges = set(ends)
    top, bottom = (2, 1) if in_hex else (4, 3)

    def decode(a: int, b: int) -> bytes:
        part = code[a:b]
        if in_hex:
            return bytes.fromhex(part[: len(part) // 2 * 2])
        part = part[:-1] if len(part) % 4 == 1 else part
        return base64.b64decode(part + "=" * (-len(part) % 4))

    def span(a: int, b: int) -> tuple[int, int]:
        i, j = bisect_right(ends, a), bisect_left(ends, b)
        last = starts[j] + len(pieces[j])
        return starts[i] + a - (ends[i] - len(pieces[i])), m.end() if j == len(ends) - 1 else last

    out, done, rests = [], 0, {}
    for found in (HEX_STARTS if in_hex else STARTS).finditer(code):
        a = found.start()
        if a < done:
            continue
        head = code[a : a + 4]
        if head in ("LS0t", "b3Bl", "2d2d", "6f70"):
            fresh = (a % top, head) not in rests  # what follows is decoded once an alignment
            first, rest = rests.setdefault((a % top, head), (a, decode(a, len(code)) if fresh else b""))
            if head in ("LS0t", "2d2d"):
                for x, _, y in find_pem(rest.decode("latin-1")) if deeper and fresh else ():
                    out.append(span(a + x * top // bottom, ends[bisect_left(ends, min(a - (-y * top // bottom), len(code)))]))
                continue
            size = key_size(rest[(a - first) // top * bottom :])
        else:
            size = key_size(decode(a, a + 4 * top))
        b = a - (-size * top // bottom) if size else None
        if b in edges and is_key(decode(a, b)):
            out.append(span(a, b))
            done = b
    if deeper:
        whole = [(0, len(code))] if len(pieces) > 1 else []
        for a, b in [*whole, *((e - len(x), e) for x, e in zip(pieces, ends, strict=True))]:
            if b - a >= LEAST_KEY * 4 // 3 and as_text(decode(a, min(b, a + 16))) and (inner := as_text(decode(a, b))) and find_keys(inner, False):
                out.append(span(a, b))
    out = sorted(set(out), key=lambda x: (x[0], -x[1]))
    reach = [0, *accumulate((b for _, b in out), max)]
    return [x for x, far in zip(out, reach, strict=False) if x[1] > far]  # none within another


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, secrets array<struct<kind, start, end>>) for every row, repeated rows included; a null or empty text has none,
    an empty table gives an empty result, a null key stays. Other columns don't matter, whatever their names."""
    picked = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in find_secrets(t.as_py())] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, SPANS)], names=["key", "secrets"])

    kind = picked.schema["key"].dataType.simpleString()
    return picked.mapInArrow(scan, f"key {kind}, secrets array<struct<kind string, start bigint, end bigint>>").withColumnRenamed("key", key)


def digest(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts by base kind, the digest of the base spans, and all spans as text."""
    text = lambda x: F.concat_ws(",", F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    base = F.filter("secrets", lambda s: s["kind"].isin(*BASE))
    count = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long")
    return scanned.select(
        key, *(count(k).alias(f"n_{k}") for k in BASE), F.sha2(text(base), 256).alias("base_sha256"), text("secrets").alias("spans"), (F.size("secrets") - F.size(base)).cast("long").alias("n_confirmed")
    )


def redact(docs: DataFrame, text: str = "text", count: str = "n_chars") -> DataFrame:
    """docs with each secret replaced by its kind in angle brackets (overlapping spans: once, by the first kind), and its
    count of code points brought up to date. All rows and columns stay; texts without a secret stay as they are."""
    at, names = docs.columns.index(text), docs.columns
    sized = names.index(count) if count in names else None

    def clean(value: str | None) -> str | None:
        spans = find_secrets(value)
        if not spans:
            return value
        out, last, k = [], 0, 0
        while k < len(spans):
            a, kind, b = spans[k]
            k += 1
            while k < len(spans) and spans[k][0] < b:
                b = max(b, spans[k][2])
                k += 1
            out += [value[last:a], f"<{KINDS[kind]}>"]
            last = b
        return "".join([*out, value[last:]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [clean(t.as_py()) for t in batch.column(at)]
            columns = list(batch.columns)
            if sized is not None:
                was = batch.column(at)
                columns[sized] = pa.array([c.as_py() if t is None or len(t) == len(o.as_py()) else len(t) for t, o, c in zip(texts, was, columns[sized], strict=True)], columns[sized].type)
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(work, docs.schema)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
