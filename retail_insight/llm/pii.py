"""Surrogates for personal data.

Entities are found by pattern (and checksum or range where their kind has
one) and replaced by keyed surrogates of the same kind and format. A
surrogate is a keyed permutation of all strings of the entity's form, so one
entity has one surrogate everywhere (coreference), two entities never share
one (distinctness) without any table, and nothing is shuffled. Where a form
has rules (a valid check digit, a number range, a name pool) the permutation
is walked until its value obeys them, which keeps it one to one.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from . import _text as tx

#: Key of the registered query; a real run passes its own secret.
DEMO_KEY = b"demonstration key"
ROUNDS = 8

# Pools of common given names by gender and script, family names.
GIVEN = {
    ("female", "latin"): "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Emma Sophie Claire Camille Ingrid Ursula Heike Carmen Lucia Pilar".split(),
    ("male", "latin"): "James Robert John Michael David William Richard Joseph Thomas Charles Pierre Antoine Jacques Hans Klaus Jürgen Carlos Miguel Javier Diego".split(),
    ("female", "cyrillic"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана".split(),
    ("male", "cyrillic"): "Иван Александр Сергей Дмитрий Андрей Алексей Михаил Николай".split(),
    ("female", "greek"): "Μαρία Ελένη Αικατερίνη Βασιλική Σοφία Άννα".split(),
    ("male", "greek"): "Γιώργος Δημήτρης Κώστας Νίκος Παναγιώτης Βασίλης".split(),
}
FAMILY = {
    "latin": "Smith Johnson Williams Brown Jones Miller Davis Wilson Anderson Taylor Martin Bernard Dubois Müller Schmidt Schneider Fischer García Fernández López".split(),
    "cyrillic": "Иванов Смирнов Кузнецов Попов Соколов Лебедев Козлов Новиков".split(),
    "greek": "Παπαδόπουλος Βλάχος Αγγελόπουλος Νικολαΐδης Γεωργίου Δημητρίου".split(),
}
_ALPHABETS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789",
              "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
              "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ")
_ALPHABET_OF = {c: a for a in _ALPHABETS for c in a}
# Other letters of addresses and names, by block and case: Latin, Greek, Cyrillic, Hebrew, Arabic, Devanagari, Thai, kana, Han, Hangul.
for _first, _last in ((0xC0, 0x24F), (0x370, 0x3FF), (0x400, 0x52F), (0x5D0, 0x5EA), (0x620, 0x64A), (0x904, 0x939),
                      (0xE01, 0xE2E), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3)):
    for _case in ("islower", "isupper", ""):
        _more = "".join(c for c in map(chr, range(_first, _last + 1)) if c.isalpha() and c not in _ALPHABET_OF
                        and (getattr(c, _case)() if _case else not c.islower() and not c.isupper()))
        _ALPHABET_OF |= dict.fromkeys(_more, _more)

_GIVEN_OF = {n: k for k, names in GIVEN.items() for n in names}
_NAMES = "|".join(sorted(_GIVEN_OF, key=len, reverse=True))
# Letters of scripts that are written without spaces, or with endings on foreign words: they end an entity of other letters.
_DENSE = "ก-໿က-႟ក-៿ぁ-ヿ㐀-䶿一-鿿가-힣豈-﫿"
_PLAIN = rf"[^\W{_DENSE}]"       # a word character of other scripts
_CHAR = rf"(?:{_PLAIN}|[̀-ͯ])"
_LETTER = rf"[^\W\d_{_DENSE}]"
_LABEL = rf"(?:[^\W_{_DENSE}]|[̀-ͯ-]){{1,63}}"
_TOP = rf"(?:xn--[A-Za-z0-9-]{{2,59}}|{_LETTER}{{2,24}})"
_DENSE_DOMAIN = rf"(?:{_LABEL}\.)*[{_DENSE}]{{1,63}}\.(?:[{_DENSE}]{{2,10}}|{_TOP})"
_HEX = "[0-9a-fA-F]{1,4}"
_FAMILY = rf"(?:[^\W\d_a-zа-яα-ω{_DENSE}]{_LETTER}+|[{_DENSE}]{{2,}})"
_CAPITAL = rf"(?=[^\Wa-z])[^\W\d_a-zа-яα-ωß-öø-ÿά-ώѐ-џ{_DENSE}]"
_WORD = rf"{_CAPITAL}{_LETTER}+(?:[-'’]{_CAPITAL}{_LETTER}+)*"
_TITLE = ("Mrs?|Ms|Mx|Miss|Mister|Dr|Prof|Professor|Sir|Madam|Mme|Mlle|Madame|Monsieur|Herrn?|Frau|Sr|Sra|Señora?|Don|Doña|Signora?"
          "|[Гг]осподин|[Гг]оспожа|[Гг]-н|[Гг]-жа|[Κκ]ύριος|[Κκ]υρία|[Κκ]ος|[Κκ]α")
_BEFORE = ("[Mm]y name is|[Nn]ame ?:|[Ss]igned by|[Ww]ritten by|[Aa]uthor ?:|[Cc]ontact ?:|[Aa]ttn[.:]|Dear|Sincerely,|[Rr]egards,"
           "|[Ii]ch heiße|[Jj]e m['’]appelle|[Mm]e llamo|[Мм]еня зовут|[Μμ]ε λένε")
PATTERNS = (
    ("email", re.compile(rf"(?:(?<!{_PLAIN})(?<![̀-ͯ.%+-])(?:{_CHAR}|[.%+-]){{1,64}}|(?<![{_DENSE}])[{_DENSE}]{{1,64}})"
                         rf"@(?:{_DENSE_DOMAIN}|(?:{_LABEL}\.)+{_TOP})(?![^\W_{_DENSE}])")),
    ("iban", re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?!\w)", re.ASCII)),
    ("card", re.compile(r"(?<!\w)(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|3\d{3}([ -])\d{6}\2\d{5})(?![\w-])", re.ASCII)),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", re.ASCII)),
    ("phone", re.compile(r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\w)"
                         r"|(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)|(?<![\w.-])\d{3}([ .-])\d{3}\1\d{4}(?![\w-])", re.ASCII)),
    ("ip", re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\w]|\.\d)", re.ASCII)),
    ("ip6", re.compile(rf"(?<!\w)(?<![0-9a-fA-F:]:)(?:{_HEX}(?::{_HEX}){{7}}(?!\w|:[0-9a-fA-F])"
                       rf"|{_HEX}(?::{_HEX}){{0,6}}::(?:{_HEX}(?::{_HEX}){{0,6}})?(?![\w:.]|:[0-9a-fA-F])"
                       rf"|{_HEX}(?::{_HEX}){{0,6}}::(?:{_HEX}(?::{_HEX}){{0,6}})?(?=[:.](?![0-9a-fA-F:])))", re.ASCII)),
    ("name", re.compile(rf"(?<!{_PLAIN})(?P<given>{_NAMES})(?P<gap>[  ])(?P<family>{_FAMILY})(?!{_PLAIN})")),
    ("name", re.compile(rf"(?<!\w)(?:(?:{_TITLE})\.?|{_BEFORE})\s(?:(?:{_TITLE})\.?[  ])*"
                        rf"(?P<person>{_WORD}(?:[  ](?:{_CAPITAL}\.|{_WORD})){{0,2}})(?!{_PLAIN})")),
)
KINDS = tuple(dict.fromkeys(k for k, _ in PATTERNS))


def luhn(digits: str) -> int:
    """The check digit that follows ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def permute(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of range(size): a Feistel network, walked until the value is in range."""
    if size < 2:
        return value
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, (half + 7) // 8
    person = hashlib.blake2b(tweak.encode(), digest_size=16).digest()
    while True:
        left, right = value >> half, value & mask
        for r in range(ROUNDS):
            text = bytes([r]) + right.to_bytes(width, "big")
            word = hashlib.blake2b(text, key=key, person=person, digest_size=min(64, max(8, width))).digest()
            stretched = word if width <= 64 else hashlib.shake_256(key + person + text).digest(width)
            left, right = right, left ^ (int.from_bytes(stretched, "big") & mask)
        value = (left << half) | right
        if value < size:
            return value


def same_form(text: str, key: bytes, tweak: str, good=None) -> str:
    """Letters and digits permuted among all strings of the same form: each
    character stays in its alphabet and case, others stay as they are.
    ``good``: a rule that the result keeps or fails as ``text`` does."""
    want = good(text) if good else None
    # a value per alphabet position: a number in mixed radix
    while True:
        value, size = 0, 1
        for c in text:
            alphabet = _ALPHABET_OF.get(c)
            if alphabet:
                value = value * len(alphabet) + alphabet.index(c)
                size *= len(alphabet)
        value = permute(value, size, key, tweak)
        out = []
        for c in reversed(text):
            alphabet = _ALPHABET_OF.get(c)
            if alphabet:
                value, at = divmod(value, len(alphabet))
                c = alphabet[at]
            out.append(c)
        text = "".join(reversed(out))
        if good is None or good(text) == want:
            return text


def _pooled(word: str, pool: list[str], key: bytes, tweak: str) -> str:
    """Within the pool for its members; other words never become members."""
    if word in pool:
        return pool[permute(pool.index(word), len(pool), key, tweak)]
    return same_form(word, key, tweak, good=lambda w: w in pool)


def _with_digits(text: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in text)


def _iban_valid(text: str) -> bool:
    s = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _private(value: int) -> tuple[bool, ...]:
    first, second = value >> 24, value >> 16 & 255
    return first == 10, first == 127, first == 172 and 16 <= second < 32, first == 192 and second == 168, first in (0, 255)


def _ip(text: str, key: bytes) -> str:
    value = int.from_bytes(bytes(map(int, text.split("."))), "big")
    kind = _private(value)
    value = permute(value, 1 << 32, key, "ip")
    while _private(value) != kind:
        value = permute(value, 1 << 32, key, "ip")
    return ".".join(map(str, value.to_bytes(4, "big")))


def _phone(text: str, key: bytes) -> str:
    """By country code and national number, however they are written; a number without ``+`` is in the form of country 1."""
    digits = re.sub(r"\D", "", text)
    code = ""
    if text[0] == "+":
        code = next((digits[:n] for n in (1, 2) if digits[:n] in _COUNTRY), digits[:3])
    trunk = "0" if "(0)" in text and digits[len(code):len(code) + 1] == "0" else ""
    national = digits[len(code + trunk):]
    new = same_form(national, key, f"phone+{code or '1'}", good=lambda t: t[:1] in tuple("23456789"))
    return _with_digits(text, code + trunk + new)


def _ip6(text: str, key: bytes) -> str:
    """Within its kind of network: those leading bits stay, the others are permuted."""
    value = int(ipaddress.IPv6Address(text))
    fixed = next((n for net, n in _NETS if value >> 128 - n == net), 3)
    left = 128 - fixed
    value = value >> left << left | permute(value & (1 << left) - 1, 1 << left, key, f"ip6{value >> left},{fixed}")
    address = ipaddress.IPv6Address(value)
    new = address.exploded if len(text) == 39 else address.compressed
    return new.upper() if text.upper() == text and text.lower() != text else new


#: Country codes of one and two digits; all others have three.
_COUNTRY = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
                     "81 82 84 86 90 91 92 93 94 95 98".split())
#: Documentation, link-local, unique local, multicast.
_NETS = tuple((int(ipaddress.IPv6Network(n).network_address) >> 128 - (k := ipaddress.IPv6Network(n).prefixlen), k)
              for n in ("2001:db8::/32", "fe80::/10", "fc00::/7", "ff00::/8"))


def _is_ip6(text: str) -> bool:
    """Valid, and not a slice or a scope of a program: ``1::2``, ``a::b``."""
    try:
        address = ipaddress.IPv6Address(text)
    except ValueError:
        return False
    groups = [g for g in text.split(":") if g]
    return (re.search("[0-9]", text) is not None and (len(groups) > 3 or len(groups[0]) == 4)
            and not address.is_loopback)


def _is_card(text: str, at: int, number: str) -> bool:
    """A long number that a mark precedes can be a phone, a fraction or part of another number."""
    mark, digits = text[at - 1:at] if at else "", re.sub(r"\D", "", number)
    if mark == "+":
        return len(digits) > 15
    if mark not in (".", "-") or not re.match("[0-9A-Za-z_]", text[at - 2:at - 1] if at > 1 else ""):
        return True
    before = re.search(r"\w+$", text[max(0, at - 40):at - 1], re.ASCII)[0]
    if not before[-1].isdigit():
        return mark == "." or digits[0] in "3456" and luhn(digits[:-1]) == int(digits[-1])
    return before.strip("0") != "" and digits[0] in "3456" and luhn(digits[:-1]) == int(digits[-1])


def _name(text: str, key: bytes) -> str:
    """Word by word: the last is the family name, the others are given names."""
    parts = re.split(r"([ \u00a0])", text)
    *given, family = parts[::2]
    script = _GIVEN_OF[given[0]][1] if given and given[0] in _GIVEN_OF else next(
        (s for s, lo, hi in (("greek", "\u0370", "\u03ff"), ("cyrillic", "\u0400", "\u052f")) if lo <= family[0] <= hi), "latin")
    for i, word in enumerate(given):
        if word in _GIVEN_OF:
            gender, of = _GIVEN_OF[word]
            parts[2 * i] = _pooled(word, GIVEN[gender, of], key, f"{gender}{of}")
        else:
            parts[2 * i] = same_form(word, key, "given", good=lambda w: w in _GIVEN_OF)
    parts[-1] = _pooled(family, FAMILY[script], key, f"family{script}")
    return "".join(parts)


@lru_cache(maxsize=100_000)
def surrogate(kind: str, text: str, key: bytes) -> str:
    """The replacement of one entity. Case in e-mail addresses is kept, the
    domain has its own surrogate, and its last label stays."""
    if kind == "email":
        local, domain = text.rsplit("@", 1)
        labels, top = domain.rsplit(".", 1)
        return f"{same_form(local, key, 'email')}@{same_form(labels, key, 'domain')}.{top}"
    if kind == "card":
        digits = re.sub(r"\D", "", text)
        body = digits[0] + same_form(digits[1:-1], key, f"card{digits[0]}{len(digits)}")
        check = (luhn(body) + int(digits[-1]) - luhn(digits[:-1])) % 10     # valid stays valid
        return _with_digits(text, body + str(check))
    if kind == "ssn":
        return same_form(text, key, "ssn", good=lambda t: t[:3] not in ("000", "666") and t[0] != "9"
                         and t[4:6] != "00" and t[7:] != "0000")
    if kind == "phone":
        return _phone(text, key)
    if kind == "ip":
        return _ip(text, key)
    if kind == "ip6":
        return _ip6(text, key)
    if kind == "iban":
        body = same_form(text[4:], key, f"iban{text[:2]}")
        s = body.replace(" ", "") + text[:2] + "00"
        check = 98 - int("".join(str(int(c, 36)) for c in s)) % 97
        return f"{text[:2]}{check:02d}{body}"
    return _name(text, key)


def entities(text: str) -> list[tuple[int, int, str]]:
    """Entities (start, end, kind) in order; of overlapping ones the kind listed first."""
    found: list[tuple[int, int, str]] = []
    has_digit = re.search(r"\d", text) is not None
    for kind, pattern in PATTERNS:
        if kind == "email" and "@" not in text or kind not in ("email", "name") and not has_digit:
            continue
        if kind == "ip6" and "::" not in text and text.count(":") < 7:
            continue
        for m in pattern.finditer(text):
            if (kind == "iban" and not _iban_valid(m[0]) or kind == "ip6" and not _is_ip6(m[0])
                    or kind == "card" and not _is_card(text, m.start(), m[0])):
                continue
            start, end = m.span("person" if "person" in pattern.groupindex else 0)
            if all(end <= s or start >= e for s, e, _ in found):
                found.append((start, end, kind))
    return sorted(found)


#: Further keys that are tried for an entity whose surrogate another one of the text has.
_RETRIES = 64


def canonical(kind: str, text: str) -> str:
    """One spelling of an entity that has several."""
    return ipaddress.IPv6Address(text).exploded if kind == "ip6" else text


def replace(text: str, key: bytes) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with surrogates, and the entities. Spellings of one entity may
    share a surrogate; entities of one text that differ have different ones.
    This is checked: one whose surrogate is taken gets another, by a further key."""
    found = entities(text)
    given: dict[str, tuple[str, str]] = {}
    out, at = [], 0
    for start, end, kind in found:
        word = text[start:end]
        who, new = (kind, canonical(kind, word)), surrogate(kind, word, key)
        for again in range(1, _RETRIES):
            if given.setdefault(new, who) == who:
                break
            new = surrogate(kind, word, key + bytes([again]))
        out += [text[at:start], new]
        at = end
    return "".join([*out, text[at:]]), found


def find_and_replace(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                     key: bytes = DEMO_KEY) -> DataFrame:
    """Every row's text with surrogates: id, text, n_entities, spans (kind:start:end
    in code points of the text given). A null text stays null without entities;
    rows and ids may repeat. Other columns are not read."""
    source = tx.pick(docs, id=id_col, text=text_col)
    id_type = source.schema["id"].dataType.simpleString()

    def run(block: tx.Block):
        texts, counts, spans = [], [], []
        for text in block.column("text").to_pylist():
            new, found = replace(text, key) if text else (text, [])
            texts.append(new)
            counts.append(len(found))
            spans.append(",".join(f"{k}:{s}:{e}" for s, e, k in found))
        return tx.record_batch(id=block.column("id"), text=pa.array(texts, pa.string()),
                               n_entities=pa.array(counts, pa.int64()), spans=spans)

    return tx.map_blocks(source, "text", run, f"id {id_type}, text string, n_entities long, spans string"
                         ).withColumnRenamed("id", id_col)


def replace_in_table(docs: DataFrame, *, text_col: str = "text", key: bytes = DEMO_KEY) -> DataFrame:
    """``docs``, all columns and rows, with surrogates in its texts."""
    columns = docs.columns

    def run(block: tx.Block):
        old = block.column(text_col)
        texts = [replace(t, key)[0] if t else t for t in old.to_pylist()]
        at = columns.index(text_col)
        return block.rows.set_column(at, block.rows.schema.field(at), pa.array(texts, old.type))

    return tx.map_blocks(docs, text_col, run, docs.schema)
