"""Personal data in whole texts, found by anchors and grown by local parsers.

One Aho-Corasick automaton runs over a text and reports short anchors: at-signs, schemes,
pairs of digits, a plus before a digit, and words that announce an identifier. A parser of
the anchor's kind then looks only at the characters around it: it grows the span to both
sides, checks it, and remembers where the last span of its kind ended, so that spans of one
kind never overlap. No parser tries again after a failed check, and none walks over the
same characters more than a fixed number of times.

Base kinds: email, ip, card, phone. Added kinds:

    mail     an address with letters beyond ASCII, or one written with "[at]" and "[dot]"
    profile  a web address that names a person: user information, or a user's path
    iban     an international bank account number behind that word, with right check digits
    ssn      a social security number behind its cue
    account  6 to 18 digits behind a word for an account, customer, passport or tax number
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.llm.common import free_name

Span = tuple[int, int]

BASE = ("email", "ip", "card", "phone")
ADDED = ("mail", "profile", "iban", "ssn", "account")
KINDS = (*BASE, *ADDED)

# What announces an identifier.
SCHEMES = ("http://", "https://", "ftp://", "ftps://", "sftp://", "ssh://")
IBAN_CUES = ("iban",)
SSN_CUES = ("ssn", "social security")
ACCOUNT_CUES = (
    "account", "acct", "a/c", "customer", "passport", "konto", "kontonummer", "kundennummer", "compte", "cuenta",
    "steuernummer", "tax id", "member id", "patient id",
)
AT_WORDS = ("[at]", "(at)", "{at}")
# Digits of a card and of a phone number.
CARD_DIGITS, PHONE_DIGITS, ACCOUNT_DIGITS = (13, 19), (9, 15), (6, 18)

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
WIDE_DOMAIN = re.compile(r"(?:[^\W_]|-)++(?:\.(?:[^\W_]|-)++)++")
DOT_WORD = r"[\x20]?(?:\.|\[dot\]|\(dot\)|\{dot\})[\x20]?"
SPELT_DOMAIN = re.compile(rf"[A-Za-z0-9-]++(?:{DOT_WORD}[A-Za-z0-9-]++)++", re.I)
FOUR_PARTS = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
DIGIT_CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE_REST = re.compile(r"[\x20().0-9-]*+")
ADDRESS = re.compile(r"[^\s<>\"'`{}|\\^]*+")
PERSON = re.compile(r"[^/?#]+@|[^/?#]+/(?:~|@|users?/|u/|in/|people/|profiles?/|members?/)[^/?#]|[^/?#]+/?\?(?:.*&)?(?:user|email|login)=[^&]", re.I)
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]){11,30}+(?![A-Za-z0-9])")
AFTER_CUE = re.compile(r"(?:[\x20_-]?(?:number|nummer|num|no|nr|id|code)\b)?[\x20\t.:#=\xba\xb0-]{0,4}", re.I)
SSN = re.compile(r"([0-9]{3})[\x20-]?([0-9]{2})[\x20-]?([0-9]{4})(?![0-9])")
ACCOUNT = re.compile(r"(?:[A-Z]{1,3}-?)?[0-9](?:[\x20./-]?[0-9])++(?![A-Za-z0-9])")


@lru_cache(maxsize=1)
def anchors() -> ahocorasick.Automaton:
    """The automaton of all anchors, made by rule; built once per worker, about 600 short words.

    A value is the parsers that the anchor calls and its length.
    """
    found: dict[str, set[str]] = {"@": {"email", "mail"}}

    def add(word: str, parser: str) -> None:
        found.setdefault(word, set()).add(parser)

    digits = "0123456789"
    for a in digits:
        add("+" + a, "phone")
        for b in digits:
            add(f"{a}.{b}", "ip")
            for between in ("", " ", "-"):
                add(a + between + b, "card")
    for words, parser in ((SCHEMES, "profile"), (IBAN_CUES, "iban"), (SSN_CUES, "ssn"), (ACCOUNT_CUES, "account"), (AT_WORDS, "spelt")):
        for word in words:
            for spelling in {word, word.upper(), word.capitalize(), word.title()}:
                add(spelling, parser)
    automaton = ahocorasick.Automaton()
    for word, parsers in found.items():
        automaton.add_word(word, (tuple(sorted(parsers)), len(word)))
    automaton.make_automaton()
    return automaton


def luhn(digits: str) -> bool:
    """The check sum of card numbers: every second digit from the right is doubled."""
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def mod97(number: str) -> bool:
    """The check of bank account numbers."""
    return int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


class Finder:
    """The spans of one text. A parser gets the anchor's place and notes what it finds."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.spans: dict[str, list[Span]] = {k: [] for k in KINDS}
        self.reach = dict.fromkeys((*KINDS, "spelt"), 0)

    def note(self, kind: str, start: int, end: int, good: bool = True) -> None:
        """A match that fails its check is used up like a good one, but not reported."""
        self.reach[kind] = end
        if good:
            self.spans[kind].append((start, end))

    def run(self) -> dict[str, list[Span]]:
        for last, (parsers, length) in anchors().iter(self.text):
            start = last + 1 - length
            for parser in parsers:
                if start >= self.reach[parser]:
                    getattr(self, parser)(start, last + 1)
        return self.spans

    def email(self, at: int, after: int) -> None:
        text, floor, start = self.text, self.reach["email"], at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, after)):
            self.note("email", start, domain.end())

    def mail(self, at: int, after: int) -> None:
        """Like email, but any letter counts; reported only if it holds one beyond ASCII."""
        text, floor, start = self.text, self.reach["mail"], at
        while start > floor and ((c := text[start - 1]) in LOCAL or c > "\x7f" and c.isalnum()):
            start -= 1
        if start < at and (domain := WIDE_DOMAIN.match(text, after)):
            self.note("mail", start, domain.end(), not text[start : domain.end()].isascii())

    def spelt(self, at: int, after: int) -> None:
        """``name [at] host [dot] org``; the names stand at most one space away."""
        text, floor = self.text, self.reach["spelt"]
        start = end = at - (at > floor and text[at - 1] == " ")
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        domain = SPELT_DOMAIN.match(text, after + (text[after : after + 1] == " "))
        if start < end and domain:
            self.reach["spelt"] = domain.end()
            self.spans["mail"].append((start, domain.end()))

    def ip(self, at: int, after: int) -> None:
        text, floor, start = self.text, self.reach["ip"], at
        while start > floor and "0" <= text[start - 1] <= "9":
            start -= 1
        if found := FOUR_PARTS.match(text, start):
            self.note("ip", start, found.end(), all(map(_small, found.group().split("."))))

    def card(self, at: int, after: int) -> None:
        found = DIGIT_CHAIN.match(self.text, at)
        digits = found.group().replace(" ", "").replace("-", "")
        self.note("card", at, found.end(), CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits))

    def phone(self, at: int, after: int) -> None:
        rest = PHONE_REST.match(self.text, after).group().rstrip(" ().-")
        if len(rest) > 1:
            digits = 1 + sum("0" <= c <= "9" for c in rest)
            self.note("phone", at, after + len(rest), PHONE_DIGITS[0] <= digits <= PHONE_DIGITS[1])

    def profile(self, at: int, after: int) -> None:
        rest = ADDRESS.match(self.text, after).group().rstrip(".,;:!?)]")
        if rest:
            self.note("profile", at, after + len(rest), PERSON.match(rest) is not None)

    def _value(self, at: int, after: int) -> int | None:
        """Where the value behind a cue begins; None if the cue is part of a longer word."""
        if at and self.text[at - 1].isalnum():
            return None
        value = AFTER_CUE.match(self.text, after).end()
        return value if value > after else None

    def iban(self, at: int, after: int) -> None:
        value = self._value(at, after)
        found = value is not None and IBAN.match(self.text, value)
        if found:
            self.note("iban", value, found.end(), mod97(found.group().replace(" ", "")))

    def ssn(self, at: int, after: int) -> None:
        value = self._value(at, after)
        found = value is not None and SSN.match(self.text, value)
        if found:
            area, group, serial = found.groups()
            self.note("ssn", value, found.end(), area not in ("000", "666") and area < "900" and group != "00" and serial != "0000")

    def account(self, at: int, after: int) -> None:
        value = self._value(at, after)
        found = value is not None and ACCOUNT.match(self.text, value)
        if found:
            digits = sum("0" <= c <= "9" for c in found.group())
            self.note("account", value, found.end(), ACCOUNT_DIGITS[0] <= digits <= ACCOUNT_DIGITS[1])


def find_spans(text: str) -> dict[str, list[Span]]:
    """The spans of each kind in one whole text, by code points, end exclusive, in order."""
    return {kind: sorted(set(spans)) for kind, spans in Finder(text).run().items()}


def listed(spans: dict[str, list[Span]], kinds: Sequence[str] = KINDS) -> str:
    """kind:start:end of all spans, by kind as listed, then start; joined by commas."""
    return ",".join(f"{kind}:{a}:{b}" for kind in kinds for a, b in spans[kind])


def redact(text: str, spans: dict[str, list[Span]]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    out, at = [], 0
    for start, end, kind in sorted((a, -b, KINDS.index(kind)) for kind, found in spans.items() for a, b in found):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, -end)
    return "".join([*out, text[at:]])


def find(docs: DataFrame) -> DataFrame:
    """``docs`` with base, spans, the number of each base kind, and redacted.

    ``base`` and ``spans`` list kind:start:end in whole texts by code points, end exclusive,
    by kind and then start; base has the four base kinds, spans has all. ``redacted`` is the
    text with its spans replaced by their kind. A null text has no findings and stays null;
    an empty or very long text is one like any other, and a task holds the findings of one
    batch of texts. Repeated rows get equal results, an empty table gives an empty one. All
    other columns are kept; the new names get underscores where they are taken.
    """
    names = docs.columns
    text_at = [n.lower() for n in names].index("text")
    strings = [free_name(docs, n) for n in ("base", "spans", "redacted")]
    counts = [free_name(docs, f"n_{kind}") for kind in BASE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, spans, clean = [], [], []
            numbers: list[list[int]] = [[] for _ in BASE]
            for value in batch.column(text_at):
                text = value.as_py()
                found = find_spans(text or "")
                base.append(listed(found, BASE))
                spans.append(listed(found))
                clean.append(redact(text, found) if spans[-1] else text)
                for number, kind in zip(numbers, BASE):
                    number.append(len(found[kind]))
            columns = [pa.array(c, pa.string()) for c in (base, spans, clean)] + [pa.array(n, pa.int64()) for n in numbers]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*names, *strings, *counts])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, schema + "".join(f", {n} string" for n in strings) + "".join(f", {n} long" for n in counts))
