"""Secret scans: patterns find candidates, and structure confirms encoded keys.

Base kinds: ``assign`` (a name such as password or api_key, a sign, a value), ``access`` (AKIA...),
``hex`` (long lower-case hex runs). Structural kinds, reported only when decoding confirms them:

* ``der``: base64, base64url or hex that decodes to an ASN.1 SEQUENCE whose elements' lengths fill it exactly, and so on
  within each constructed element, and whose elements are those of a private key: RSA (nine integers), DSA (six), SEC 1
  (a scalar, a curve), PKCS 8 plain (an algorithm, an octet string) or encrypted,
* ``sshkey``: base64 or hex of openssh-key-v1 whose parts are all there: cipher, its parameters, as many public keys as
  it states, and a private part that, where it isn't encrypted, holds equal check numbers, the same algorithm, that
  algorithm's strings and the padding,
* ``jwt``: three base64url parts whose first decodes to a JSON object with ``alg`` and whose others decode.

Public keys, certificates and signatures decode as well, but are no secrets and no spans. base64 of a whole key file
is a span of the key's kind.

A base64 key starts at a line's run of 24 or more base64 characters and goes on over lines of any
length, indented or not, for as many characters as its own header states; there a run must end. Lines may end with
an escaped ``\\n``, as in JSON. So neither a short last line nor what follows on the next line changes what is found.
An openssh-key-v1 that is cut short counts from its public keys on. Less than 16 bytes are no key.

Spans are code points, end exclusive. A null or empty text has no spans. The whole text is searched,
however long; memory is that of one text. Repeated rows get equal spans, spans at one start are in the
order of kinds, an empty table gives an empty result, and columns named like an output are replaced.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import append_columns, col

KINDS = ("assign", "access", "hex", "der", "sshkey", "jwt")

#: ASCII letters of the names in either case; re.A keeps other letters that fold to them out.
_ASSIGN = re.compile(r"""(?ia:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: The first line of a base64 key: what a SEQUENCE and openssh-key-v1 begin with.
_START = re.compile(r"(?:(?<![A-Za-z0-9+/])|(?<=\\n))(?=M[A-P]|b3BlbnNzaC1rZXktdjEA)[A-Za-z0-9+/]{24,}")
_LINES = re.compile(r"[A-Za-z0-9+/]+(?:(?:[ \t]*\r?\n|(?:\\r)?\\n)[ \t]*[A-Za-z0-9+/]+)*")
_BREAK = re.compile(r"(?:[ \t]*\r?\n|(?:\\r)?\\n)[ \t]*")
#: Lines of a key that is cut short.
_CUT = re.compile(r"[A-Za-z0-9+/]{24,}(?:(?:\r?\n|(?:\\r)?\\n)[A-Za-z0-9+/]{16,})*")
#: A key file that is encoded once more: what five dashes and BEGIN become.
_FILE = re.compile(r"(?<![A-Za-z0-9+/])LS0tLS1CRUdJTi[A-Za-z0-9+/]{24,}={0,2}")
_ANY_HEX = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{32,}(?![0-9A-Fa-f])")
#: The same on one line in the alphabet for URLs, with a character that only that one has.
_URL = re.compile(r"(?<![A-Za-z0-9_-])(?=[A-Za-z0-9]*[_-])(?:M[A-P]|b3BlbnNzaC1rZXktdjEA)[A-Za-z0-9_-]{22,}(?![A-Za-z0-9_-])")
#: A brace, or space before it, and anything after.
_JWT = re.compile(r"(?<![A-Za-z0-9_-])(?:e[w-z0-9_-]|[ICD][A-Za-z0-9_-])[A-Za-z0-9_-]{9,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*")

_MAGIC = b"openssh-key-v1\0"
#: Strings of a private key by its algorithm, the comment included.
_SSH_PARTS = {b"ssh-rsa": 7, b"ssh-dss": 6, b"ssh-ed25519": 3, b"ecdsa-sha2-nistp256": 4, b"ecdsa-sha2-nistp384": 4, b"ecdsa-sha2-nistp521": 4}
#: Encoded object identifiers under which encryption with a password is listed.
_PASSWORD_BASED = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))


def _der_length(data: bytes, at: int) -> tuple[int, int] | None:
    """(content start, content end) of the element at ``at``, or None if its length is not DER."""
    if at + 2 > len(data):
        return None
    n = data[at + 1]
    at += 2
    if n >= 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or at + k > len(data):
            return None
        n = int.from_bytes(data[at : at + k], "big")
        at += k
    return (at, at + n) if at + n <= len(data) else None


#: Constructed elements within each other at most; keys and certificates have about ten.
_DEPTH = 40


def _filled(data: bytes, at: int, end: int, depth: int = 0) -> int:
    """Elements that fill data[at:end] exactly, those within constructed ones too; 0 if they don't."""
    n = 0
    while at < end:
        inner = _der_length(data, at)
        if inner is None or inner[1] > end or (data[at] == 0x02 and inner[0] == inner[1]):
            return 0
        if data[at] & 0x20 and inner[0] < inner[1] and (depth == _DEPTH or not _filled(data, *inner, depth + 1)):
            return 0
        at, n = inner[1], n + 1
    return n


def is_der(data: bytes) -> bool:
    """A SEQUENCE that fills the data and whose elements, two or more with INTEGER or SEQUENCE first, fill it."""
    if len(data) < 16 or data[0] != 0x30 or not (outer := _der_length(data, 0)) or outer[1] != len(data):
        return False
    return data[outer[0]] in (0x02, 0x30) and _filled(data, *outer) >= 2


def _elements(data: bytes, at: int, end: int) -> list[tuple[int, bytes]]:
    """(tag, content) of the elements that fill data[at:end]."""
    out = []
    while at < end:
        a, b = _der_length(data, at)
        out.append((data[at], data[a:b]))
        at = b
    return out


def is_private_key(data: bytes) -> bool:
    """DER whose elements are those of an RSA, DSA, SEC 1 or PKCS 8 private key."""
    if not is_der(data):
        return False
    parts = _elements(data, *_der_length(data, 0))
    tags = bytes(t for t, _ in parts)
    first, second = parts[0][1], parts[1][1]
    named = lambda x: x[:1] == b"\x06"
    if tags[0] == 0x30:
        return tags == b"\x30\x04" and named(first) and first[2:].startswith(_PASSWORD_BASED)
    if first not in (b"\0", b"\1"):
        return False
    if tags.strip(b"\x02") in (b"", b"\x30") and tags[:6] == b"\x02" * 6:
        return len(tags) == 9 or (first == b"\0" and len(tags) == 6) or (first == b"\1" and len(tags) == 10 and tags[9] == 0x30)
    rest = set(tags[3:]) <= {0xA0, 0xA1, 0x81}
    if tags[:3] == b"\x02\x30\x04":
        return rest and named(second)
    return first == b"\1" and tags[:2] == b"\x02\x04" and set(tags[2:]) <= {0xA0, 0xA1} and len(second) >= 16


def _strings(data: bytes, at: int, count: int) -> tuple[list[bytes], int] | None:
    """``count`` strings with 4-byte lengths from ``at`` on, and where they end."""
    out = []
    for _ in range(count):
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + n > len(data):
            return None
        out.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return out, at


def _ssh_public(data: bytes) -> tuple[int, bytes, list[bytes]] | None:
    """(where the private part begins, cipher, algorithms) of an openssh-key-v1 that may be cut short after its public keys."""
    if not data.startswith(_MAGIC) or not (got := _strings(data, len(_MAGIC), 3)):
        return None
    (cipher, kdf, options), at = got
    keys = int.from_bytes(data[at : at + 4], "big")
    plain = cipher == b"none"
    if not cipher or not cipher.isascii() or plain != (kdf == b"none") or plain == bool(options) or not 0 < keys <= len(data) // 8:
        return None
    if not (got := _strings(data, at + 4, keys)):
        return None
    names = []
    for blob in got[0]:
        name = _strings(blob, 0, 1)
        at = name[1] if name else len(blob)
        while at < len(blob):
            at = more[1] if (more := _strings(blob, at, 1)) else len(blob) + 1
        if not name or at != len(blob) or name[1] == len(blob) or not name[0][0].isascii():
            return None
        names += name[0]
    return got[1], cipher, names


def ssh_length(data: bytes) -> int:
    """The length that the openssh-key-v1 at the beginning of ``data`` states; 0 if it is none."""
    public = _ssh_public(data)
    return public[0] + 4 + int.from_bytes(data[public[0] : public[0] + 4], "big") if public and public[0] + 4 <= len(data) else 0


def is_ssh_key(data: bytes) -> bool:
    """openssh-key-v1 with all of its parts."""
    if not (public := _ssh_public(data)) or not (got := _strings(data, public[0], 1)):
        return False
    _, cipher, names = public
    (private,), end = got
    if end != len(data) and cipher in (b"none", b"aes256-ctr", b"aes256-cbc"):  # others may add a tag
        return False
    if len(private) < 16 or len(private) % 8:
        return False
    if cipher != b"none":
        return True
    at = 8
    if private[:4] != private[4:8]:
        return False
    for name in names:
        own = _strings(private, at, 1)
        if not own or own[0][0] != name:
            return False
        if name not in _SSH_PARTS:  # what follows depends on the algorithm
            return True
        if not (own := _strings(private, own[1], _SSH_PARTS[name])):
            return False
        at = own[1]
    return private[at:] == bytes(range(1, len(private) - at + 1))


def _unb64(part: str) -> bytes | None:
    part = re.sub(r"\s", "", part).rstrip("=")
    try:
        return base64.b64decode(part + "=" * (-len(part) % 4))
    except (binascii.Error, ValueError):
        return None


def _der_total(head: bytes) -> int:
    """The length that a SEQUENCE states, header included; 0 if its first element can't be a key's."""
    if len(head) < 7:
        return 0
    n, at = head[1], 2
    if n >= 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4:
            return 0
        n, at = int.from_bytes(head[2 : 2 + k], "big"), 2 + k
    return at + n if head[0] == 0x30 and head[at] in (0x02, 0x30) else 0


def key_kind(data: bytes) -> int | None:
    """The place in KINDS of the private key that ``data`` is."""
    return 3 if is_private_key(data) else 4 if is_ssh_key(data) else None


def _encoded_keys(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind as an index) of base64 keys, over any number of lines."""
    found: list[tuple[int, int, int]] = []
    done = run_end = 0
    for m in _START.finditer(text):
        start = m.start()
        if start < done:
            continue
        if start >= run_end:
            run_end = _LINES.match(text, start).end()
            chars, offsets, ends = [], {}, {}
            n = 0
            line = start
            for gap in [(b.start(), b.end()) for b in _BREAK.finditer(text, start, run_end)] + [(run_end, run_end)]:
                offsets[line] = n
                chars.append(text[line : gap[0]])
                n += gap[0] - line
                ends[n] = gap[0]
                line = gap[1]
            chars = "".join(chars)
        at = offsets[start]

        def upto(total: int) -> int | None:
            """Where the text of ``total`` bytes from here ends, if a line's run ends there too."""
            return ends.get(at + (4 * total + 2) // 3)  # noqa: B023

        head = _unb64(chars[at : at + 40]) or _unb64(chars[at : at + 24])
        kind, end = 0, None
        if head[0] == 0x30:
            total = _der_total(head)
            if total and (end := upto(total)) and is_private_key(_unb64(chars[at : at + (4 * total + 2) // 3])):
                kind = 3
        elif head.startswith(_MAGIC):
            rest = len(chars) - at
            data = _unb64(chars[at : at + rest - (rest % 4 == 1)])
            total = ssh_length(data)
            if total and total <= len(data):
                if (end := upto(total)) and is_ssh_key(data[:total]):
                    kind = 4
            elif _ssh_public(data):  # cut short, unless it goes on in the alphabet for URLs
                end = _CUT.match(text, start).end()
                kind = 0 if text[end : end + 1] in ("-", "_") else 4
        if kind:
            done = end
            while done < min(len(text), end + 2) and text[done] == "=":
                done += 1
            found.append((start, done, kind))
    return found


def is_signed_token(token: str) -> bool:
    """A first part that decodes to a JSON object with a string ``alg``, and two more that decode."""
    try:
        head, *rest = [base64.urlsafe_b64decode(x + "=" * (-len(x) % 4)) for x in token.split(".")]
        if len(rest) != 2:
            return False
        got = json.loads(head)
    except (ValueError, RecursionError):
        return False
    return isinstance(got, dict) and isinstance(got.get("alg"), str)


def scan(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of a text, by start, then kind as in KINDS."""
    if not text:
        return []
    found = [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    found += _encoded_keys(text)
    for m in _FILE.finditer(text):
        inner = _encoded_keys((_unb64(m[0]) or _unb64(m[0].rstrip("=")[:-1]) or b"").decode("latin-1"))
        found += [(m.start(), m.end(), kind) for kind in sorted({k for *_, k in inner})]
    for m in _ANY_HEX.finditer(text):
        if len(m[0]) % 2 == 0 and (kind := key_kind(bytes.fromhex(m[0]))):
            found.append((m.start(), m.end(), kind))
    for m in _URL.finditer(text):
        if len(m[0]) % 4 != 1 and (kind := key_kind(base64.urlsafe_b64decode(m[0] + "=" * (-len(m[0]) % 4)))):
            found.append((m.start(), m.end(), kind))
    if "." in text:
        found += [(m.start(), m.end(), 5) for m in _JWT.finditer(text) if is_signed_token(m[0])]
    found.sort(key=lambda s: (s[0], s[2], s[1]))
    return [(a, b, KINDS[k]) for a, b, k in found]


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def find_secrets(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with n_assign, n_access, n_hex, base_sha256 and spans."""
    fields = [T.StructField(f"n_{k}", T.LongType(), False) for k in KINDS[:3]]
    fields += [T.StructField("base_sha256", T.StringType(), False), T.StructField("spans", T.StringType(), False)]

    def make() -> Callable:
        def apply(texts):
            out = {f.name: [] for f in fields}
            for text in texts:
                spans = scan(text)
                base = [s for s in spans if s[2] in KINDS[:3]]
                for k in KINDS[:3]:
                    out[f"n_{k}"].append(sum(s[2] == k for s in base))
                out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(spans))
            return out

        return apply

    return append_columns(docs, fields, make, keep=keep)


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each union of overlapping spans in ``text`` replaced by ``mark``; no row goes.

    Texts without spans, nulls included, stay as they are.
    """
    def make() -> Callable:
        def apply(texts):
            out = []
            for text in texts:
                spans = scan(text)
                if not spans:
                    out.append(text)
                    continue
                parts, at = [], 0
                for a, b, _ in spans:
                    if a >= at:
                        parts += [text[at:a], mark]
                    at = max(at, b)
                out.append("".join(parts) + text[at:])
            return {"text": out}

        return apply

    fields = [T.StructField("text", T.StringType(), True)]
    return append_columns(docs, fields, make).select(*map(col, docs.columns))
