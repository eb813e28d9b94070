"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, address schemes and
identifier cues. Local parsers expand each anchor to the boundaries of what it may
belong to and validate it:

- ``@``: the local part to the left and the domain to the right (kind email);
- ``mailto:``, ``tel:``, ``://`` and the like: the address that follows, kept where it
  names a person: a mailbox, a number, or user data before the host (kind address);
- ``iban``, ``ssn``, ``account``, ``password`` and other cues: the value that follows
  them, kept where it looks like an identifier (kind account).

Numbers need no cue: ip, card and phone are read from their digits. Every parser
looks at a piece of text once, so the work is linear in the text however long.
Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "address", "account")
Span = tuple[int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_BOX = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+")
_DIAL = re.compile(r"\+?[0-9](?:[().-]?[0-9]){4,}+")
_USER = re.compile(r"[^\s/?#@:\"'<>]++(?::[^\s/?#@\"'<>]*+)?+@[A-Za-z0-9.-]++")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_BETWEEN = re.compile(r"(?:[\x20\t]*+(?:no|nr|number|id|key|is|code)\b\.?)?[\"']?[\x20\t]*+([:=#]{0,2})[\x20\t]*+[\"']?", re.I | re.A)
_VALUE = re.compile(r"[A-Za-z0-9](?:[_/+.-]?[A-Za-z0-9]){4,}+")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_AKIA = re.compile(r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])")

MAIL_SCHEMES = ("mailto:", "sip:", "sips:", "xmpp:")
DIAL_SCHEMES = ("tel:", "sms:", "callto:")
CUES = (
    "account", "acct", "api key", "api-key", "api_key", "apikey", "iban", "login", "passport", "passwd", "password",
    "secret", "ssn", "tax id", "tax_id", "taxid", "token", "user id", "user_id", "userid", "username",
)
SECRETS = frozenset(("api key", "api-key", "api_key", "apikey", "passwd", "password", "secret", "token"))
_LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    plain = [("@", "at"), ("://", "scheme"), ("akia", "akia")]
    plain += [(x, "mail") for x in MAIL_SCHEMES] + [(x, "dial") for x in DIAL_SCHEMES] + [(x, "cue") for x in CUES]
    for word, kind in plain:
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


_ANCHORS = _automaton()


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if not i & 1 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _email(text: str, at: int, floor: int) -> Span | None:
    """The address around an at-sign; its local part starts at ``floor`` at the earliest."""
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    found = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, found.end()) if found else None


def _ips(text: str) -> Iterator[Span]:
    for chain in _NUMBERS.finditer(text):
        parts = chain.group().split(".")
        at = chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def _after(text: str, at: int, floor: int, kind: str) -> Span | None:
    """What follows a scheme: from the scheme's first letter to the address' end."""
    if kind == "scheme":
        found = _USER.match(text, at + 3)
        start = at
        while found and start > floor and text[start - 1] in _SCHEME:
            start -= 1
        while start < at and not text[start].isalpha():
            start += 1
        return (start, found.end()) if found and start < at else None
    size = text.find(":", at) + 1
    found = (_BOX if kind == "mail" else _DIAL).match(text, size)
    if not found or at > floor and text[at - 1].isalnum():
        return None
    return at, found.end()


def _account(text: str, at: int, end: int) -> Span | None:
    """The identifier behind a cue, without the cue: one with four digits, or, behind a
    secret's cue and a sign, any value."""
    if at and text[at - 1].isalnum() or end < len(text) and text[end].isalpha():
        return None
    between = _BETWEEN.match(text, end)
    value = between.end()
    if value == end:  # nothing between: no value is looked at, so that none is read twice
        return None
    cue = text[at:end].lower()
    if cue == "iban":
        found = _IBAN.match(text, value)
        return found.span() if found and _mod97(found.group()) else None
    found = _VALUE.match(text, value)
    if not found or not (cue in SECRETS and between[1]) and sum(c.isdigit() for c in found.group()) < 4:
        return None
    return found.span()


def _mod97(iban: str) -> bool:
    plain = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def spans(text: str) -> dict[str, list[Span]]:
    """The spans of each kind, in order and apart from one another within a kind."""
    found: dict[str, list[Span]] = {k: [] for k in KINDS}
    ends = dict.fromkeys(KINDS, 0)

    def add(kind: str, span: Span | None) -> None:
        if span and span[0] >= ends[kind]:
            found[kind].append(span)
            ends[kind] = span[1]

    # cues in any case; letters beyond A-Z stay, so that offsets do
    lower = text.lower() if text.isascii() else text.translate(_LOWER)
    for last, (what, size) in _ANCHORS.iter(lower):
        at = last - size + 1
        if what == "at":
            add("email", _email(text, at, ends["email"]))
        elif what in ("scheme", "mail", "dial"):
            add("address", _after(text, at, ends["address"], what))
        elif what == "akia":
            key = _AKIA.match(text, at)
            add("account", key.span() if key and not (at and text[at - 1].isalnum()) else None)
        else:
            add("account", _account(text, at, last + 1))
    found["ip"] = list(_ips(text))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found["card"].append(m.span())
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            found["phone"].append(m.span())
    return found


def _joined(found: dict[str, list[Span]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found[k])


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    ``spans`` has every span as kind:start:end, base kinds first; ``base_sha256`` is
    the digest of the base kinds alone. A null text is an empty one, without spans.
    Null and repeated doc_ids keep a row each; other columns are ignored. A single map
    over the rows: no shuffle, and memory for one batch of texts.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = []
            for text in part.column(1):
                found = spans(text.as_py() or "")
                digest = hashlib.sha256(_joined(found, BASE).encode()).hexdigest()
                rows.append((*(len(found[k]) for k in BASE), digest, _joined(found, KINDS)))
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            names = ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, columns, kinds)], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in BASE) + ", base_sha256 string, spans string"
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)
