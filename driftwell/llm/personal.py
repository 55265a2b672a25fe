"""Personal data by anchor expansion: an Aho-Corasick automaton finds cues, local parsers expand and validate."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame

from driftwell.llm.common import id_text, whole_text, with_id

# Kinds in their order, base kinds first.
KINDS = ("email", "ip", "card", "phone", "url", "iban", "ssn", "account", "secret")
BASE = KINDS[:4]
# Characters of the base patterns.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
LABEL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")
DIGITS = frozenset("0123456789")
CARD_GAPS = frozenset(" -")
PHONE_INNER = frozenset(" ().0123456789-")
# Cue words and the kind each announces.
CUES = {
    "ssn": "ssn", "social security": "ssn", "iban": "iban", "account": "account", "acct": "account", "konto": "account",
    "cuenta": "account", "compte": "account", "passport": "account", "token": "secret", "api_key": "secret",
    "api key": "secret", "apikey": "secret", "password": "secret", "passwd": "secret", "secret": "secret",
}
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
AFTER_CUE = re.compile(r"(?:[ _-]?(?:number|no\.?|nr\.?|id|key))?[\"']?\s{0,2}(?:[:=#]\s{0,2}|is\s)[\"']?", re.IGNORECASE)
VALUES = {
    "ssn": re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "iban": re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{2,4}){3,8}(?![A-Za-z0-9])"),
    "account": re.compile(r"[A-Z]{0,3}[0-9][0-9 -]{4,22}[0-9](?![A-Za-z0-9])"),
}
# A secret is a run of these with a digit in it, at least so long; a link ends before white space and these.
SECRET, DIGIT, SHORTEST_SECRET = re.compile(r"[A-Za-z0-9_./+=-]*"), re.compile("[0-9]"), 16
LINK_END, LINK_TAIL = re.compile(r"[\s<>\"']"), ".,;)"


def automaton() -> ahocorasick.Automaton:
    """What each cue starts. Cues are in lower case; a text is searched in a copy with small A-Z."""
    a = ahocorasick.Automaton()
    a.add_word("@", (1, "@"))
    a.add_word("+", (1, "+"))
    for d in DIGITS:
        a.add_word(d, (1, "digit"))
    for scheme in SCHEMES:
        a.add_word(scheme, (len(scheme), "url"))
    for cue, kind in CUES.items():
        a.add_word(cue, (len(cue), kind))
    a.make_automaton()
    return a


AUTOMATON = automaton()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid_iban(text: str) -> bool:
    bare = text.replace(" ", "")
    return 15 <= len(bare) <= 34 and int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1


def _run(text: str, at: int, of: frozenset) -> int:
    """End of the run of characters of a set that starts at ``at``."""
    while at < len(text) and text[at] in of:
        at += 1
    return at


class Finder:
    """The spans of one text. Each base kind keeps where its last match ended: matches do not overlap."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.end = dict.fromkeys(BASE, 0)
        self.base: list[tuple[int, int, str]] = []
        self.more: list[tuple[int, int, str]] = []
        # where what is looked for next was found last, so that no part of a text is searched twice for the same
        self.next: dict[str, int] = {"@": -1, "/": -1, "digit": -1}
        self.link = self.secret = (0, 0)

    def _next(self, what: str, at: int) -> int:
        """The first place from ``at`` on that holds ``what``; the end of the text if there is none."""
        if self.next[what] < at:
            if what == "digit":
                found = DIGIT.search(self.text, at)
                self.next[what] = found.start() if found else len(self.text)
            else:
                place = self.text.find(what, at)
                self.next[what] = place if place >= 0 else len(self.text)
        return self.next[what]

    def email(self, at: int) -> None:
        """Around an at-sign: the local part before it, as far as it reaches, and two labels or more after it."""
        t = self.text
        start, floor = at, self.end["email"]
        while start > floor and t[start - 1] in LOCAL:
            start -= 1
        if start == at:
            return
        stop = _run(t, at + 1, LABEL)
        if stop == at + 1:
            return
        dots = 0
        while stop < len(t) and t[stop] == "." and (after := _run(t, stop + 1, LABEL)) > stop + 1:
            stop, dots = after, dots + 1
        if dots:
            self.base.append((start, stop, "email"))
            self.end["email"] = stop

    def ip(self, at: int) -> None:
        """Four runs of digits joined by dots, from the first digit of a run."""
        t, stop, parts = self.text, _run(self.text, at, DIGITS), []
        parts.append(t[at:stop])
        while len(parts) < 4:
            if stop >= len(t) or t[stop] != "." or (after := _run(t, stop + 1, DIGITS)) == stop + 1:
                # no match from here nor from a later digit of this run; the next run may start one
                return
            parts.append(t[stop + 1 : after])
            stop = after
        self.end["ip"] = stop
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in parts):
            self.base.append((at, stop, "ip"))

    def card(self, at: int) -> None:
        """Digits with single blanks or hyphens between them."""
        t, stop = self.text, at + 1
        while stop < len(t):
            if t[stop] in DIGITS:
                stop += 1
            elif t[stop] in CARD_GAPS and stop + 1 < len(t) and t[stop + 1] in DIGITS:
                stop += 2
            else:
                break
        if stop == at + 1:
            return
        self.end["card"] = stop
        digits = [c for c in t[at:stop] if c in DIGITS]
        if 14 <= len(digits) <= 19 and luhn("".join(digits)):
            self.base.append((at, stop, "card"))

    def phone(self, at: int) -> None:
        """A plus sign, a digit, and inner characters up to the last digit."""
        t = self.text
        if at + 1 >= len(t) or t[at + 1] not in DIGITS:
            return
        stop = _run(t, at + 2, PHONE_INNER)
        while stop > at + 3 and t[stop - 1] not in DIGITS:
            stop -= 1
        if stop <= at + 3:
            return
        self.end["phone"] = stop
        if 10 <= sum(c in DIGITS for c in t[at:stop]) <= 15:
            self.base.append((at, stop, "phone"))

    def url(self, start: int, stop: int) -> None:
        """A link that carries a name and a password, or a mail address, before its host."""
        if not self.link[0] <= stop < self.link[1]:  # another run without white space
            found = LINK_END.search(self.text, stop)
            self.link = (stop, found.start() if found else len(self.text))
        end = self.link[1]
        if self._next("@", stop) < min(self._next("/", stop), end):
            while end > stop and self.text[end - 1] in LINK_TAIL:
                end -= 1
            self.link = (stop, max(stop + 1, end))
            self.more.append((start, end, "url"))

    def _secret(self, at: int) -> int:
        """Where the run at a place ends, if it is long enough and holds a digit; else the place."""
        if not self.secret[0] <= at < self.secret[1]:
            self.secret = (at, SECRET.match(self.text, at).end())
        end = self.secret[1]
        return end if end - at >= SHORTEST_SECRET and self._next("digit", at) < end else at

    def cue(self, kind: str, start: int, stop: int) -> None:
        """The value that a cue word announces, when the word stands alone and the value has its shape."""
        t = self.text
        if start and (t[start - 1].isalnum()):
            return
        bridge = AFTER_CUE.match(t, stop)
        if not bridge:
            return
        if kind == "secret":
            end = self._secret(bridge.end())
        else:
            value = VALUES[kind].match(t, bridge.end())
            found = value.group() if value else ""
            while kind == "iban" and found and not valid_iban(found):
                found = found.rpartition(" ")[0]  # the last group may be the next word
            end = bridge.end() + len(found)
        if end > bridge.end():
            self.more.append((bridge.end(), end, kind))

    def spans(self) -> tuple[list, list]:
        end, before = self.end, -2
        # bytes.lower touches A-Z only, so places stay
        small = self.text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
        for last, (size, what) in AUTOMATON.iter(small):
            start = last - size + 1
            if what == "digit":
                first = start != before + 1  # of its run
                before = start
                if start >= end["ip"] and (first or start == end["ip"]):
                    self.ip(start)
                if start >= end["card"]:
                    self.card(start)
            elif what == "@":
                self.email(start)
            elif what == "+":
                if start >= end["phone"]:
                    self.phone(start)
            elif what == "url":
                self.url(start, last + 1)
            else:
                self.cue(what, start, last + 1)
        rank = {k: i for i, k in enumerate(KINDS)}
        self.base.sort(key=lambda s: (s[0], rank[s[2]]))
        taken: list = []
        for s in sorted(set(self.more), key=lambda s: (s[0], -s[1])):  # added spans do not nest in each other
            if not taken or s[0] >= taken[-1][1]:
                taken.append(s)
        return self.base, sorted(self.base + taken, key=lambda s: (s[0], rank[s[2]]))


def joined(spans: list) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


COLUMNS = "doc_id string, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"


def find_personal(docs: DataFrame) -> DataFrame:
    """Spans of personal data in each text, one row per input row; positions are code points, ends exclusive.

    The base kinds (email, ip, card, phone) follow their patterns exactly, from
    left to right without overlap inside a kind; failing matches are dropped.
    Cue words and schemes add links with credentials, bank numbers, social
    security numbers, account numbers and secrets, where the announced value has
    the right shape. Counts and base_sha256 are of the base kinds.

    Cues and schemes are found in any case. No part of a text is searched twice
    for the same, so time grows with its length whatever it repeats.

    A null or empty text has no spans. Null ids and repeated rows are searched
    like any others. An empty table gives an empty result. Other columns are
    ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
                base, spans = Finder(text).spans()
                counts = [sum(s[2] == kind for s in base) for kind in BASE]
                rows.append((doc_id, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in COLUMNS.split(", ")])

    return with_id(docs.select(id_text().alias("doc_id"), whole_text().alias("text")).mapInPandas(run, COLUMNS))
