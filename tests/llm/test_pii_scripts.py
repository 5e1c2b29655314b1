"""Entities beside letters of other scripts, in other scripts, IPv6, names by title."""

import pytest

from retail_insight.llm import pii

KEY = b"k"
FOUND = [
    ("联系abc@mail.com。", "email", "abc@mail.com"), ("IP是161.17.88.162的", "ip", "161.17.88.162"),
    ("电话+1 (386) 555-1832号", "phone", "+1 (386) 555-1832"), ("to josé.34@mail7.example.com now", "email", "josé.34@mail7.example.com"),
    ("to josé.34@mail7.example.com", "email", "josé.34@mail7.example.com"),
    ("abc@müller.de", "email", "abc@müller.de"), ("x abc@mail.com_ y", "email", "abc@mail.com"), ("张三@例子.中国", "email", "张三@例子.中国"),
    ("иван@почта.рф,", "email", "иван@почта.рф"), ("メールはabc@mail.comです", "email", "abc@mail.com"), ("番号123-45-6789です", "ssn", "123-45-6789"),
    ("no.4703443633947811", "card", "4703443633947811"), ("+4703443633947811", "card", "4703443633947811"),
    ("a -4703443633947811.", "card", "4703443633947811"), ("1.4539148803436467", "card", "4539148803436467"),
    ("卡4703443633947811号", "card", "4703443633947811"), ("at 2001:db8:85a3::8a2e:370:7334.", "ip6", "2001:db8:85a3::8a2e:370:7334"),
    ("IP:fe80::1ff:fe23:4567:890a, up", "ip6", "fe80::1ff:fe23:4567:890a"), ("2A02:8108:8AC0:0207:0000:0000:0000:0001 x", "ip6", "2A02:8108:8AC0:0207:0000:0000:0000:0001"),
    ("请问2001:db8::7吗", "ip6", "2001:db8::7"), ("asked Dr. Ouheal today", "name", "Ouheal"), ("Mrs Xenia Q. Ouheal-Bat, here", "name", "Xenia Q. Ouheal-Bat"),
    ("my name is Xenia Ouheal.", "name", "Xenia Ouheal"), ("Frau Öztürk kam", "name", "Öztürk"), ("联系Mary Smith先生", "name", "Mary Smith"),
    ("see Prof.\u00a0Xenia\u00a0Ouheal", "name", "Xenia\u00a0Ouheal"), ("господин Петренко ушёл", "name", "Петренко"), ("+4915123456789", "phone", "+4915123456789"),
]


@pytest.mark.parametrize("text, kind, entity", FOUND)
def test_found_and_replaced(text, kind, entity):
    at = text.index(entity)
    assert pii.entities(text) == [(at, at + len(entity), kind)]
    new, _ = pii.replace(text, KEY)
    (start, end, again), = pii.entities(new)
    assert again == kind and start == at and new[start:end] != entity
    assert new[:start] == text[:at] and new[end:] == text[at + len(entity):]


@pytest.mark.parametrize("text", ["0.4539148803436467", "a[10::2] std::b2 f::a 12:30:45 ::1", "v1.2.3.4.5", "the doctor came",
                                  "dear Sir or Madam", "a@b 日本@例"])
def test_not_found(text):
    assert pii.entities(text) == []


def test_one_entity_one_surrogate():
    new = pii.replace("联系abc@mail.com。abc@mail.com", KEY)[0]
    assert new[2:].split("。")[0] == new.split("。")[1]
    family = pii.replace("Mary Smith and Dr. Smith", KEY)[0].split()
    assert family[1] == family[4]
    a, b = (pii.surrogate("ip6", t, KEY) for t in ("2a02:8108::1", "2A02:8108:0000:0000:0000:0000:0000:0001"))
    assert pii.ipaddress.ip_address(a) == pii.ipaddress.ip_address(b) != pii.ipaddress.ip_address("2a02:8108::1")
    assert len({pii.surrogate("ip6", f"fe80::{i:x}", KEY) for i in range(1000)}) == 1000
    assert pii.surrogate("ip6", "fe80::1", KEY).startswith("fe") and pii.surrogate("name", "Ouheal", KEY) != "Ouheal"


def test_one_phone_in_several_forms():
    def digits(text):
        return "".join(c for c in pii.surrogate("phone", text, KEY) if c.isdigit())

    assert digits("+1 (386) 555-1832") == "1" + digits("(386) 555-1832") == "1" + digits("386-555-1832") == digits("+13865551832")
    assert digits("+442012345678") == digits("+44 20 1234 5678") == digits("+44 (0)20 1234 5678").replace("440", "44", 1)
    assert digits("+353 1 234 5678") == digits("+35312345678")
    assert digits("+44 20 1234 5678").startswith("44") and pii.surrogate("phone", "+44 (0)20 1234 5678", KEY).startswith("+44 (0)")
    assert digits("+1 (386) 555-1832") != digits("+1 (386) 555-1833") and digits("+13865551832") != "13865551832"
    forms = [f"+44 20 1234 {i:04d}" for i in range(2000)] + [f"+44 120 1234 {i:04d}" for i in range(2000)]
    assert len({digits(f) for f in forms}) == 4000
