"""Secret scan with structural confirmation.

Three plain patterns give the base spans. Further candidates are reported
only if they decode: base64 or hex to a DER key or certificate whose nested
lengths add up, to an SSH key blob whose length-prefixed fields add up, an
armoured key block whose body decodes to one of these or to PGP packets whose
lengths add up, or a signed token whose header is a JSON object that names an
algorithm. Base64 may be wrapped, quoted or inside a string literal: line ends
(also escaped), quote marks and '>' prefixes are taken out before decoding.
One scan, no shuffle.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

from pyspark.sql import DataFrame

from . import _text as tx

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")   # 18 characters and more
HEX = re.compile(r"[0-9a-f]{16,}")
MIN_ASSIGNED = 12
BASE_KINDS = ("assign", "access", "hex")

BEGIN = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ ){0,3}(?:KEY|CERTIFICATE)(?: BLOCK)?)-----")
TOKEN = re.compile(r"(?:(?<![A-Za-z0-9_-])|(?<=\\[nrt]))(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}={0,2}")
_SEP = r"""(?:(?:\\r)?\\n(?:["'][ \t+,.\\]*\r?\n[ \t]*["'])?[ \t>|#*]*|(?:["'][ \t+,.\\]*|[ \t]*)\r?\n[ \t>|#*"']*)"""
SEP = re.compile(_SEP)
#: Base64 over two lines and more, from a line that may begin a DER SEQUENCE or an SSH key.
LINES = re.compile(rf"([MAb](?:(?<![A-Za-z0-9+/].)|(?<=\\[nrt].))(?:(?<=M)|(?<=A)AAA|(?<=b)3Blb)[A-Za-z0-9+/]{{12,}}+(?:{_SEP}[A-Za-z0-9+/]++)+)")
HEX_DATA = re.compile(r"3(?:(?<![0-9A-Za-z].)|(?<=\\[nrt].))0(?:[0-9a-f]{62,}|[0-9A-F]{62,})(?![0-9A-Za-z])")
KINDS = (*BASE_KINDS, "armour", "jwt", "der", "ssh", "hex_der")
_ORDER = {k: i for i, k in enumerate(KINDS)}


def unbase64(s: str, urlsafe: bool = False) -> bytes | None:
    """Decoded bytes, or None where the text is no base64."""
    s = s.rstrip("=")
    if len(s) % 4 == 1:
        return None
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), altchars=b"-_" if urlsafe else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def der_length(data: bytes, at: int) -> tuple[int, int] | None:
    """(content start, content end) of the DER element at ``at``; None if it doesn't fit."""
    if at + 2 > len(data):
        return None
    first = data[at + 1]
    if first < 0x80:
        start, size = at + 2, first
    else:
        n = first & 0x7F
        if not 1 <= n <= 4 or at + 2 + n > len(data) or data[at + 2] == 0:
            return None
        start, size = at + 2 + n, int.from_bytes(data[at + 2:at + 2 + n], "big")
        if size < 0x80:
            return None
    return (start, start + size) if start + size <= len(data) else None


def is_der_key(data: bytes) -> bool:
    """A SEQUENCE that fills ``data``, whose elements nest exactly, with an
    INTEGER, OBJECT IDENTIFIER, BIT or OCTET STRING of key size inside."""
    if not data or data[0] != 0x30 or (top := der_length(data, 0)) is None or top[1] != len(data):
        return False
    stack, largest, leaves = [(top[0], top[1])], 0, 0
    while stack:
        at, end = stack.pop()
        while at < end:
            inner = der_length(data, at)
            if inner is None or inner[1] > end:
                return False
            if data[at] & 0x20:
                if len(stack) > 32:
                    return False
                stack.append(inner)
            elif data[at] in (0x02, 0x03, 0x04, 0x06):
                leaves += 1
                largest = max(largest, inner[1] - inner[0])
            elif data[at] == 0:
                return False
            at = inner[1]
    return leaves >= 2 and largest >= 16


def is_ssh_blob(data: bytes) -> bool:
    """Length-prefixed fields that fill ``data``, the first an SSH algorithm name; or an OpenSSH key file."""
    if data.startswith(b"openssh-key-v1\x00"):
        return len(data) > 64
    at, fields = 0, 0
    while at < len(data):
        size = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + size > len(data):
            return False
        if not fields and not re.fullmatch(rb"(ssh|ecdsa|sk-ssh|sk-ecdsa)-[a-z0-9@.-]{2,60}", data[at + 4:at + 4 + size]):
            return False
        fields, at = fields + 1, at + 4 + size
    return fields >= 2


def is_pgp_key(data: bytes) -> bool:
    """Packets whose lengths fill ``data``, the first a key."""
    at, packets = 0, 0
    while at < len(data):
        head = data[at]
        if not head & 0x80:
            return False
        tag, at, more = head & 0x3F if head & 0x40 else head >> 2 & 15, at + 1, True
        if not packets and tag not in (5, 6):
            return False
        body = at
        while more:
            first, more = data[at:at + 1], False
            if not first:
                return False
            if not head & 0x40:
                n = (1, 2, 4, 0)[head & 3]
                size = int.from_bytes(data[at:at + n], "big") if n else len(data) - at
            elif first[0] < 192:
                n, size = 1, first[0]
            elif first[0] < 224:
                n, size = 2, (first[0] - 192 << 8) + int.from_bytes(data[at + 1:at + 2], "big") + 192
            elif first[0] < 255:
                n, size, more = 1, 1 << (first[0] & 31), True
            else:
                n, size = 5, int.from_bytes(data[at + 1:at + 5], "big")
            body, at = at + n if body == at else body, at + n + size
            if at > len(data):
                return False
        if not packets and (at - body < 16 or data[body] not in (2, 3, 4, 5, 6)):
            return False
        packets += 1
    return packets >= 1


def armoured(body: str) -> str:
    """The base64 of an armour body: escapes, quoting and header lines taken out."""
    lines = re.sub(r"\\+(?:[rnt]|u000[AaDd])", "\n", body).replace("\\/", "/").split("\n")
    out = []
    for line in lines:
        line = re.sub(r"""^[\s>|#*"']+""", "", re.sub(r"""(?:["'][\s+,.;)\\]*|\\+\s*)$""", "", line))
        if not re.match(r"[A-Za-z0-9-]+:", line):
            out += line.split()
    return "".join(out)


def key_ends(data: bytes) -> list[int]:
    """Where a key that begins ``data`` may end, by its own lengths."""
    if data[:1] == b"\x30":
        first = data[1] if len(data) > 1 else 0
        n = first & 0x7F if first & 0x80 else 0
        return [2 + n + int.from_bytes(data[2:2 + n], "big")] if n <= 4 and n else [2 + first]
    ends, at, left = [], 0, -1      # left: strings still to come; -1: any number
    if data.startswith(b"openssh-key-v1\x00"):
        at, left = 15, 3
    fields = 0
    while at + 4 <= len(data) and left:
        at += 4 + int.from_bytes(data[at:at + 4], "big")
        fields += 1
        left -= left > 0
        if fields == 3 and not left:        # the number of keys; then theirs and the private part
            left, at = int.from_bytes(data[at:at + 4], "big") + 1, at + 4
        if at <= len(data) and (left < 0 and fields >= 2 or not left):
            ends.append(at)
    return ends


def wrapped_spans(text: str) -> list[tuple[int, int, str]]:
    """Keys in base64 over several lines: their own lengths say after which line they end."""
    found = []
    for m in LINES.finditer(text):
        run, pieces, at, total, line_end = m[1], [], 0, 0, {}
        for sep in [*(x.span() for x in SEP.finditer(run)), (len(run), len(run))]:
            pieces.append(run[at:sep[0]])
            total += sep[0] - at
            if len(pieces) > 1:
                line_end[total] = m.start(1) + sep[0]
            at = sep[1]
        joined = "".join(pieces)
        data = unbase64(joined[:len(joined) // 4 * 4]) or b""
        kind, test = ("der", is_der_key) if run[0] == "M" else ("ssh", is_ssh_blob)
        for end in reversed(key_ends(data + b"\0\0")):
            need = -(-4 * end // 3)
            if need in line_end and test((unbase64(joined[:need]) or b"")[:end]):
                stop = line_end[need]
                found.append((m.start(1), stop + len(re.match("={0,2}", text[stop:stop + 2])[0]), kind))
                break
    return found


def is_token_header(segment: str) -> bool:
    data = unbase64(segment, urlsafe=True)
    try:
        header = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text)
             if m.end(2) - m.start(2) >= MIN_ASSIGNED]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda f: (f[0], _ORDER[f[2]]))


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    """Candidates whose decoded structure is that of a key or a signed token."""
    found = []
    begins = list(BEGIN.finditer(text)) if "-----BEGIN " in text else []
    for m, after in zip(begins, [*(x.start() for x in begins[1:]), len(text)]):
        mark = f"-----END {m[1]}-----"
        if (end := text.find(mark, m.end(), after)) < 0:
            continue
        raw = text[m.end():end]
        body, pgp = armoured(raw), m[1].startswith("PGP ")
        data = unbase64(re.sub("=[A-Za-z0-9+/]{4}$", "", body) if pgp else body)    # without the CRC
        if data and (is_pgp_key(data) if pgp else is_der_key(data) or is_ssh_blob(data) or "ENCRYPTED" in raw):
            found.append((m.start(), end + len(mark), "armour"))
    armours = list(found)
    for m in TOKEN.finditer(text) if "eyJ" in text else ():
        if is_token_header(m[1]) and unbase64(m[2], urlsafe=True) and unbase64(m[3], urlsafe=True) is not None:
            found.append((m.start(), m.end(), "jwt"))
    for m in BASE64.finditer(text):
        s, start = m[0], m.start()
        if s[0] in "nrt" and text[start - 1:start] == "\\":     # an escaped line end
            s, start = s[1:], start + 1
        if s.startswith("M"):       # a DER SEQUENCE begins with byte 0x30
            data, kind, test = unbase64(s), "der", is_der_key
        elif s.startswith("AAAA") or s.startswith("b3Blb"):   # a small length; openssh-key
            data, kind, test = unbase64(s), "ssh", is_ssh_blob
        else:
            continue
        if data and test(data):
            found.append((start, m.end(), kind))
    found += [f for f in wrapped_spans(text) if not any(s <= f[0] and f[1] <= e for s, e, _ in armours)]
    for m in HEX_DATA.finditer(text):
        if len(m[0]) % 2 == 0 and is_der_key(bytes.fromhex(m[0])):
            found.append((m.start(), m.end(), "hex_der"))
    return found


def render(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in found)


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secret spans of every whole text, as code-point offsets, end exclusive.

    Null text reads as empty: no spans, the digest of the empty text. Ids may
    be null or repeat; each row gives one row. Other columns are not read.
    """
    source = tx.pick(docs, id=id_col, text=text_col)
    id_type = source.schema["id"].dataType.simpleString()

    def run(block: tx.Block):
        rows = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_confirmed")}
        for text in block.column("text").to_pylist():
            base = base_spans(text or "")
            more = confirmed_spans(text or "")
            kinds = [k for _, _, k in base]
            for k in BASE_KINDS:
                rows[f"n_{k}"].append(kinds.count(k))
            rows["base_sha256"].append(hashlib.sha256(render(base).encode()).hexdigest())
            rows["spans"].append(render(sorted(base + more, key=lambda f: (f[0], _ORDER[f[2]], f[1]))))
            rows["n_confirmed"].append(len(more))
        return tx.record_batch(id=block.column("id"), **rows)

    return tx.map_blocks(source, "text", run, f"id {id_type}, n_assign long, n_access long, n_hex long, "
                         "base_sha256 string, spans string, n_confirmed long").withColumnRenamed("id", id_col)
