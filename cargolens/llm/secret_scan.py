"""Secret scans with structural confirmation.

Patterns give candidates in whole texts. A candidate is reported under a kind of its own only
after it has been decoded and parsed: a base64 or hex run must hold a nest of lengths that ends
with its last byte (DER of a key, OpenSSH wire strings), a private key block must hold such a
body or, if its header lines say that it is encrypted, whole blocks of the cipher they name, and a
signed token must have a JSON header that names an algorithm. The spans of the plain patterns are reported as they are, the confirmed ones are added.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cargolens.llm.common import small_batches

# The plain patterns, their least lengths, and the order of the kinds.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")   # a run of 16 or more is a whole run of [0-9a-f]+
LEAST_VALUE, LEAST_ACCESS = 12, 18
KINDS = ["assign", "access", "hex", "pem", "jwt", "der", "ssh"]

PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----([^-]*+(?:-(?!----)[^-]*+)*+)-----END \1-----")
PEM_BREAK = re.compile(r"\r?\n|\r|(?:\\r)?\\n|\\r")   # a line's end, or its escape in a string
PEM_FIELD = re.compile(r"([A-Za-z][A-Za-z0-9-]*):(.*)")
PEM_BODY = re.compile(r"[A-Za-z0-9+/=]*")
INITIAL = re.compile(r"(?:[0-9A-Fa-f]{16}){1,2}")   # a cipher block of 8 or 16 bytes
# A header is JSON: an encoded "{", or white space before it.
JWT = re.compile(r"(?<![A-Za-z0-9_-])((?:e[w-z0-9_-]|[CDI])[A-Za-z0-9_-]++)\.([A-Za-z0-9_-]++)\.([A-Za-z0-9_-]++)")
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}+={0,2}")
HEX_RUN = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![0-9A-Za-z])")
SSH_MAGIC = b"openssh-key-v1\x00"
SSH_NAMES = (b"ssh-", b"ecdsa-", b"sk-")
MAX_DEPTH = 12
# How a SEQUENCE, a wire string's length and the OpenSSH mark begin when they are encoded.
FIRST_BASE64, FIRST_HEX = ("M", "AAAA", "b3Bl"), ("30", "0000", "6f70")


def decoded(run: str) -> bytes | None:
    """A base64 run of either alphabet, padded or not; None if its length or last bits are wrong."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        data = base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None
    return data if base64.b64encode(data).decode().rstrip("=") == body else None


def _der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents that follow each other to the last byte."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data) or data[at] & 31 == 31:
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 128:
            width = size & 127
            if not 0 < width <= 4 or at + width > len(data) or not data[at]:
                return None
            size, at = int.from_bytes(data[at:at + width], "big"), at + width
            if size < 128:
                return None
        if at + size > len(data):
            return None
        items.append((tag, data[at:at + size]))
        at += size
    return items


def _sound(items: list[tuple[int, bytes]], depth: int = 0) -> bool:
    """Constructed items nest down to the last byte; integers and identifiers are well formed."""
    if depth > MAX_DEPTH:
        return False
    for tag, content in items:
        if tag & 32:
            inner = _der_items(content)
            if inner is None or not _sound(inner, depth + 1):
                return False
        elif tag == 2 and (not content or len(content) > 1 and content[0] in (0, 255)
                           and (content[0] ^ content[1]) < 128):
            return False
        elif tag == 6 and (not content or content[-1] & 128):
            return False
    return True


def is_der_key(data: bytes) -> bool:
    """One SEQUENCE over all bytes that starts like a key: a version and numbers or an
    algorithm (private), an algorithm and a bit string (public), or an algorithm with parameters
    and an octet string (encrypted; a digest's algorithm has none)."""
    items = _der_items(data) if data[:1] == b"\x30" else None
    if not items or len(items) != 1 or not _sound(items):
        return False
    inner = _der_items(items[0][1])
    tags = [tag for tag, _ in inner or []]
    if tags[:1] == [2] and len(inner[0][1]) == 1 and inner[0][1][0] <= 2:
        return (len(tags) >= 6 and set(tags[1:6]) == {2} or tags[1:3] == [48, 4]
                or tags[1:2] == [4])
    if tags[:2] == [48, 3] and len(tags) == 2:
        return bool((first := _der_items(inner[0][1])) and first[0][0] == 6)
    if tags[:2] == [48, 4] and len(tags) == 2:
        return bool(inner[1][1]) and [tag for tag, _ in _der_items(inner[0][1]) or []] == [6, 48]
    return tags[:2] == [2, 2] and len(tags) == 2 and len(inner[0][1]) >= 64   # modulus, exponent


def _wire_strings(data: bytes) -> list[bytes] | None:
    """Strings with a length of four bytes each, to the last byte."""
    out, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + size > len(data) or at + 4 > len(data):
            return None
        out.append(data[at + 4:at + 4 + size])
        at += 4 + size
    return out


def is_ssh_key(data: bytes) -> bool:
    if data.startswith(SSH_MAGIC):
        rest, strings = data[len(SSH_MAGIC):], []
        for _ in range(3):     # cipher, derivation, its options
            size = int.from_bytes(rest[:4], "big")
            if len(rest) < 4 + size:
                return False
            strings.append(rest[4:4 + size])
            rest = rest[4 + size:]
        keys = _wire_strings(rest[4:])
        return (len(rest) > 4 and keys is not None
                and len(keys) == int.from_bytes(rest[:4], "big") + 1)
    strings = _wire_strings(data)
    return bool(strings) and len(strings) >= 2 and strings[0].startswith(SSH_NAMES)


def pem_parts(block: str) -> tuple[dict[str, str], bytes | None]:
    """Header fields (names in lower case) and decoded body of what stands between the marks."""
    lines = [line for part in PEM_BREAK.split(block) if (line := part.strip())]
    fields, name, at = {}, None, 0
    for at, line in enumerate([*lines, ""]):
        if m := PEM_FIELD.fullmatch(line):
            name = m[1].lower()
            fields[name] = m[2].strip()
        elif name is None or PEM_BODY.fullmatch(line):
            break
        else:
            fields[name] += line    # a field that goes on
    body = re.sub(r"\s", "", "".join(lines[at:]))
    return fields, decoded(body) if PEM_BODY.fullmatch(body) else None


def is_private_block(block: str) -> bool:
    """A key's structure, or an encrypted body: the fields say so and name the cipher with its
    initial block, and the body is whole blocks where the cipher's mode asks for them."""
    fields, body = pem_parts(block)
    if not body:
        return False
    if "ENCRYPTED" in fields.get("proc-type", "").upper():
        cipher, _, initial = (x.strip() for x in fields.get("dek-info", "").partition(","))
        return bool(cipher and INITIAL.fullmatch(initial)
                    and (not cipher.upper().endswith("-CBC") or len(body) % (len(initial) // 2) == 0))
    return is_der_key(body) or is_ssh_key(body)


def is_signed_token(header: str, payload: str, signature: str) -> bool:
    """A JSON header with an algorithm, a body that decodes, and a signature unless it is none."""
    try:
        fields = json.loads(decoded(header) or b"")
    except (ValueError, RecursionError):
        return False
    return (isinstance(fields, dict) and isinstance(fields.get("alg"), str)
            and decoded(payload) is not None and decoded(signature) is not None)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the plain patterns; kind is a place in ``KINDS``."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
             if m.end(1) - m.start(1) >= LEAST_VALUE]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)
              if m.end() - m.start() >= LEAST_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return spans


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of candidates whose decoded structure holds."""
    spans = []
    for m in PEM.finditer(text) if "-----BEGIN " in text else ():
        if is_private_block(m[2]):
            spans.append((m.start(), 3, m.end()))
    for m in JWT.finditer(text):
        if is_signed_token(*m.groups()):
            spans.append((m.start(), 4, m.end()))
    for m in RUN.finditer(text):
        data = decoded(m[0]) if m[0].startswith(FIRST_BASE64) else None
        if data and (der := is_der_key(data)) | is_ssh_key(data):
            spans.append((m.start(), 5 if der else 6, m.end()))
    for m in HEX_RUN.finditer(text):
        if len(m[0]) % 2 == 0 and m[0].lower().startswith(FIRST_HEX):
            data = bytes.fromhex(m[0])
            if (der := is_der_key(data)) | is_ssh_key(data):
                spans.append((m.start(), 5 if der else 6, m.end()))
    return spans


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id and ``spans``, an array of (kind, start, end, base) by
    start, then kind, in code points, end exclusive.

    A null text is empty; doc_id may be null and rows may repeat; other columns are not read.
    One scan, nothing is shuffled, and whole texts are searched however long.
    """
    small_batches(docs.sparkSession)
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                      ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                spans = base_spans(text) + confirmed_spans(text)
                found.append([{"kind": KINDS[k], "start": a, "end": b, "base": k < 3}
                              for a, k, b in sorted(spans)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(item))], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean>>")


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts of the plain kinds, a digest of their spans, and all spans as text."""
    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return scan_secrets(docs).select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(text(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_confirmed"))
