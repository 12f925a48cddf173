"""Secrets in texts: patterns, and encodings that hold a key or a signed token by their own structure.

The patterns give spans of three kinds: ``assign`` (a value after a telling name), ``access`` (access
key ids) and ``hex`` (long lower-case hex runs). On top, base64 and hex candidates are decoded and
reported only where what they decode to has the structure of a secret:

``der``    a private key whose DER lengths nest without a gap: RSA, EC, PKCS#8 and encrypted PKCS#8;
``ssh``    an OpenSSH private key, whose length-prefixed fields fill it;
``pem``    such a key between its BEGIN and END lines, or such a block that was itself put into base64;
``jwt``    a signed token: a JSON header that names an algorithm, a JSON object as payload, and a
           signature of the length that the algorithm makes.

Candidates are decoded as far as the length that they state for themselves, and only at the beginning of a run of their characters, so a text is
scanned in time in proportion to its length. A bare key that is cut into lines is found as ``pem`` only.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from stockpond.llm.native import free_name

# Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "pem", "der", "ssh", "jwt")

# The patterns of the base kinds and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_LEAST = 6
# A run that is too short holds no other beginning that is long enough, so the least length can be part of the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

# Signature bytes by algorithm; RSA signatures are as long as the key.
SIGNATURE = {"HS256": {32}, "HS384": {48}, "HS512": {64}, "ES256": {64}, "ES256K": {64}, "ES384": {96}, "ES512": {132}, "EdDSA": {64, 114}}
RSA_SIGNATURE = {"RS256", "RS384", "RS512", "PS256", "PS384", "PS512"}
RSA_LEAST = 128

SSH_MAGIC = b"openssh-key-v1\0"
LEAST_KEY = 32  # bytes; the shortest private keys in DER have more
SEQUENCE, INTEGER, OCTETS, OBJECT, CONTEXT_0 = 0x30, 0x02, 0x04, 0x06, 0xA0

# A DER sequence begins with byte 0x30, in base64 "M"; what follows is checked once it is decoded.
BASE64_START = re.compile(r"(?<![A-Za-z0-9+/_-])(?:M[A-P]|b3BlbnNzaC1rZXktdjEA)[A-Za-z0-9+/_-]{40,}")
HEX_START = re.compile(r"(?<![0-9A-Fa-f])(?:30(?=[0-9A-Fa-f])|6f70656e7373682d6b65792d763100|6F70656E7373682D6B65792D763100)[0-9A-Fa-f]{64,}")
PEM_BEGIN = re.compile(r"-----BEGIN ((?:[A-Z0-9]{1,16} ){0,4})PRIVATE KEY-----")
# "-----BEGIN " in base64.
PEM_PACKED = re.compile(r"(?<![A-Za-z0-9+/])LS0tLS1CRUdJTi[A-Za-z0-9+/]{40,}={0,2}")
# Header lines of older keys, real and written-out line ends, and the characters that base64 skips.
PEM_SKIP = re.compile(r"^[A-Za-z0-9-]+:[^\n]*$|\\r|\\n|\s", re.MULTILINE)
JWT = re.compile(r"(?<![A-Za-z0-9_-])(e[w-z0-9_-][A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]{20,})(?![A-Za-z0-9_-])")


def decoded(run: str) -> bytes | None:
    """Bytes of base64, of either alphabet, with or without padding; None where it is none."""
    run = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(run) % 4 == 1:
        return None
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, first byte and end of the contents of the DER element at ``at``; None unless it lies whole before ``end``."""
    if at + 2 > end:
        return None
    tag, length, at = data[at], data[at + 1], at + 2
    if length >= 0x80:
        width = length & 0x7F
        if not 1 <= width <= 4 or at + width > end:
            return None
        length = int.from_bytes(data[at : at + width], "big")
        if length < 0x80 or length >> 8 * (width - 1) == 0:  # DER takes the shortest form
            return None
        at += width
    return (tag, at, at + length) if at + length <= end else None


def elements(data: bytes, at: int, end: int, most: int = 16) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``at`` to ``end`` without a gap; None if they don't or are more than a key has."""
    out = []
    while at < end:
        found = element(data, at, end)
        if found is None or len(out) == most:
            return None
        out.append(found)
        at = found[2]
    return out


def der_length(head: bytes) -> int | None:
    """How many bytes the sequence that begins here takes, by its own length."""
    if len(head) < 6 or head[0] != SEQUENCE:
        return None
    if head[1] < 0x80:
        return 2 + head[1]
    width = head[1] & 0x7F
    if not 1 <= width <= 4:
        return None
    return 2 + width + int.from_bytes(head[2 : 2 + width], "big")


def is_private_key(data: bytes) -> bool:
    """Whether the bytes are one DER sequence, filled without a gap, with the members of a private key."""
    outer = element(data, 0, len(data))
    if outer is None or outer[0] != SEQUENCE or outer[2] != len(data) or len(data) < LEAST_KEY:
        return False
    inner = elements(data, outer[1], outer[2])
    if not inner or len(inner) < 2:
        return False
    tags = [tag for tag, _, _ in inner]
    if tags == [SEQUENCE, OCTETS]:  # encrypted: algorithm, octets
        return _is_algorithm(data, inner[0]) and inner[1][2] - inner[1][1] >= 16
    if tags[0] != INTEGER or inner[0][2] - inner[0][1] != 1:
        return False
    version = data[inner[0][1]]
    if tags[1:] == [INTEGER] * 8 and version == 0:  # RSA: modulus, exponents, primes, coefficients
        return inner[1][2] - inner[1][1] >= 64
    if tags[1:] == [INTEGER] * 5 and version == 0:  # DSA: p, q, g and the pair of keys
        return inner[1][2] - inner[1][1] >= 64
    if tags[1] == OCTETS and version == 1:  # EC: the number, perhaps curve and point
        return inner[1][2] - inner[1][1] >= 16 and all(CONTEXT_0 <= t <= CONTEXT_0 + 1 for t in tags[2:])
    if tags[1:3] == [SEQUENCE, OCTETS] and version <= 1:  # PKCS#8: algorithm, key
        return _is_algorithm(data, inner[1]) and inner[2][2] - inner[2][1] >= 16
    return False


def _is_algorithm(data: bytes, member: tuple[int, int, int]) -> bool:
    inside = elements(data, member[1], member[2])
    return bool(inside) and inside[0][0] == OBJECT and inside[0][2] - inside[0][1] >= 3


def ssh_key_length(data: bytes) -> int | None:
    """Bytes that an OpenSSH private key takes by the lengths of its fields; None where they don't fit."""
    if not data.startswith(SSH_MAGIC):
        return None
    at = len(SSH_MAGIC)

    def field() -> bytes | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        length = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + length > len(data):
            return None
        at += 4 + length
        return data[at - length : at]

    cipher, kdf, options = field(), field(), field()
    if not cipher or not kdf or options is None or not (cipher.isascii() and kdf.isascii()) or at + 4 > len(data):
        return None
    number = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if not 1 <= number <= 16:
        return None
    for _ in range(number):
        public = field()
        if public is None or len(public) < 4 or int.from_bytes(public[:4], "big") + 4 > len(public):
            return None
    private = field()
    return at if private and len(private) >= 16 else None


def is_signed_token(header: str, payload: str, signature: str) -> bool:
    head = _json_object(header)
    if head is None or not isinstance(head.get("alg"), str) or _json_object(payload) is None:
        return False
    made = decoded(signature)
    if made is None:
        return False
    return len(made) in SIGNATURE.get(head["alg"], ()) or (head["alg"] in RSA_SIGNATURE and len(made) >= RSA_LEAST)


def _json_object(part: str) -> dict | None:
    data = decoded(part)
    try:
        value = json.loads(data) if data is not None else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def key_in(run: str, per: int, decode) -> tuple[str, int] | None:
    """Kind and characters of the key that begins with a run of ``per`` characters for three bytes."""
    head = decode(run[: 8 * per])
    if head is None:
        return None
    if head.startswith(SSH_MAGIC[: len(head)]):
        data = decode(run)
        size = ssh_key_length(data) if data else None
        return None if size is None else ("ssh", -(-size * per // 3))
    size = der_length(head)
    if size is None or -(-size * per // 3) > len(run):
        return None
    chars = -(-size * per // 3)
    data = decode(run[:chars])
    return ("der", chars) if data is not None and is_private_key(data[:size]) else None


def _from_base64(run: str) -> bytes | None:
    whole = run[: len(run) - 1] if len(run) % 4 == 1 else run
    return decoded(whole)


def _from_hex(run: str) -> bytes | None:
    return bytes.fromhex(run[: len(run) // 2 * 2])


def pem_blocks(text: str) -> Iterator[tuple[int, int]]:
    """Blocks whose contents are a private key."""
    for begin in PEM_BEGIN.finditer(text):
        end_line = f"-----END {begin[1]}PRIVATE KEY-----"
        stop = text.find("-----", begin.end())
        if stop < 0 or not text.startswith(end_line, stop):
            continue
        body = text[begin.end() : stop]
        data = decoded(PEM_SKIP.sub("", body))
        # Older keys with a password are encrypted as a whole: their header lines say so.
        sealed = data is not None and "ENCRYPTED" in body and len(data) >= LEAST_KEY and len(data) % 8 == 0
        if data is not None and (sealed or is_private_key(data) or ssh_key_length(data) == len(data)):
            yield begin.start(), stop + len(end_line)


def spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive, sorted by start, then by ``KINDS``."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    if "-----BEGIN " in text:
        found += [("pem", a, b) for a, b in pem_blocks(text)]
    for m in PEM_PACKED.finditer(text):
        data = decoded(m[0])
        if data is not None and next(pem_blocks(data.decode("latin-1")), None):
            found.append(("pem", *m.span()))
    for starts, per, decode in ((BASE64_START, 4, _from_base64), (HEX_START, 6, _from_hex)):
        for m in starts.finditer(text):
            key = key_in(m[0], per, decode)
            if key:
                found.append((key[0], m.start(), m.start() + key[1]))
    found += [("jwt", *m.span()) for m in JWT.finditer(text) if is_signed_token(m[1], m[2], m[3])]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def with_spans(docs: DataFrame, text: str = "text", alias: str = "spans") -> DataFrame:
    """``docs`` with an array of (kind, start, end) of all secrets in the whole ``text``.

    Row by row, without a shuffle: repeated rows, ties and null or clashing ids are no matter. Null and
    empty texts have no spans. Very long texts are scanned whole; a task holds one batch of texts.
    A column already called ``alias`` is replaced; all others stay.
    """

    @F.pandas_udf("array<struct<kind:string,start:bigint,end:bigint>>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in spans(t)] for t in batch], dtype=object)

    made = free_name(docs, "_found")
    return docs.withColumn(made, scan(F.coalesce(F.col(text), F.lit("")))).withColumn(alias, F.col(made)).drop(made)
