"""Keys that are wrapped, quoted, escaped or in PGP armour."""

import base64
import json
import random

import pytest

from retail_insight.llm import secrets

_bytes = random.Random(7).randbytes


def tlv(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x82]) + n.to_bytes(2, "big")
    return bytes([tag]) + size + body


def string(b):
    return len(b).to_bytes(4, "big") + b


def wrap(data, width=64, end="\n"):
    s = base64.b64encode(data).decode()
    return end.join(s[i:i + width] for i in range(0, len(s), width))


KEYS = [tlv(0x30, tlv(2, b"\0") + tlv(2, b"\x7f" + _bytes(n)) + tlv(2, b"\1\0\1")) for n in (255, 256, 257)]
KEY = KEYS[0]
BLOB = string(b"ssh-rsa") + string(b"\1\0\1") + string(b"\0" + _bytes(256))
OPENSSH = (b"openssh-key-v1\0" + string(b"none") + string(b"none") + string(b"") + (1).to_bytes(4, "big")
           + string(BLOB) + string(_bytes(300)))
PEM = f"-----BEGIN PRIVATE KEY-----\n{wrap(KEY)}\n-----END PRIVATE KEY-----\n"
CONTENT = b"\4" + _bytes(400)
PGP = [b"\x95" + len(CONTENT).to_bytes(2, "big") + CONTENT + b"\xb4\x05a <b>",
       b"\xc5" + bytes([192 + (len(CONTENT) - 192 >> 8), len(CONTENT) - 192 & 255]) + CONTENT + b"\xcd\x05a <b>"]


def pgp(data, crc="=aB3d"):
    return f"-----BEGIN PGP PRIVATE KEY BLOCK-----\nVersion: GnuPG v2\n\n{wrap(data)}\n{crc}\n-----END PGP PRIVATE KEY BLOCK-----"


def kinds(text):
    return {k for _, _, k in secrets.confirmed_spans(text)}


@pytest.mark.parametrize("text", [
    PEM, json.dumps({"type": "service_account", "private_key": PEM}), json.dumps(json.dumps({"private_key": PEM})),
    json.dumps({"k": PEM.replace("\n", "\r\n")}), json.dumps({"k": PEM}).replace("/", "\\/"),
    "\n".join("> " + x for x in PEM.split("\n")), "\n".join(f'  "{x}\\n" +' for x in PEM.rstrip().split("\n")),
    pgp(PGP[0]), pgp(PGP[1]), json.dumps(pgp(PGP[0])), "\n".join("> " + x for x in pgp(PGP[1]).split("\n")),
    pgp(PGP[0], crc=""), "-----BEGIN PRIVATE KEY-----\n" + PEM])
def test_armour(text):
    (start, end, kind), = secrets.confirmed_spans(text)
    assert kind == "armour" and text[start:].startswith("-----BEGIN ") and text[:end].endswith("-----")


@pytest.mark.parametrize("data, kind", [*((k, "der") for k in KEYS), (BLOB, "ssh"), (OPENSSH, "ssh")])
@pytest.mark.parametrize("width", [32, 64, 76])
def test_wrapped_without_armour(data, kind, width):
    for end in ("\n", "\r\n", "\\n", "\n> ", '"\n    "', '\\n"\n  "'):
        body = wrap(data, width, end)
        for before, after in (("key:\n", "\n"), ("", ""), ("x ", "\nend of it\n"), ('{"k": "', '"}'), ("日\\n", "\\n")):
            assert secrets.confirmed_spans(before + body + after) == [(len(before), len(before) + len(body), kind)], (end, before)


def test_one_line_after_an_escape():
    one = wrap(KEY, 10_000)
    assert secrets.confirmed_spans('"\\n' + one + '"') == [(3, 3 + len(one), "der")]
    assert kinds("\\n" + KEY.hex()) == {"hex_der"}


@pytest.mark.parametrize("text", [
    wrap(KEY[:-3]), wrap(KEY[:200]), pgp(PGP[0][:-1]), pgp(PGP[1] + b"\xc5"), pgp(b"\xb4" + PGP[0][1:]),
    wrap(_bytes(300)), "M" * 70 + "\n" + "A" * 64 + "\nMore words", json.dumps({"k": PEM[:200] + PEM[210:]})])
def test_what_is_no_key(text):
    assert not kinds(text)
