"""Personal data by anchor expansion.

One Aho-Corasick pass finds anchors: at-signs, plus signs, digits, schemes and identifier cues. A deterministic local
parser then expands each anchor to the left and right, validates it and settles its bounds. Kinds:

base    email, ip, card, phone, by the patterns in ``BASE``, leftmost and non-overlapping within a kind
method  url (an address with a user part or a bare IP host, or after mailto: / tel:), account (an IBAN by its check
        digits, or the value after an identifier cue such as "account" or "passport"), secret (the value after a cue
        such as "password" or "api key")

Cues and schemes count in any case of ASCII letters. Defined results: a null text counts as empty and has no spans; repeated
documents each get a row. A run of characters that several anchors look at (a link, a secret, an account) is measured once and
answers all of them, so each character is visited a bounded number of times and very long texts cost in proportion to their
length, hostile ones too.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_of

#: Fixed patterns of the contract.
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
KINDS = ["email", "ip", "card", "phone", "url", "account", "secret"]
ACCOUNT_CUES = ("account", "acct", "iban", "passport", "ssn", "customer id", "member id", "user id")
SECRET_CUES = ("password", "passwd", "secret", "api key", "api_key", "apikey", "access key", "token")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
RUN = re.compile(r"[0-9]+")
SPACED = re.compile(r"[0-9](?:[ -]?[0-9])+")
PLUS = re.compile(r"[ ().0-9-]+")
LINK = re.compile(r"[^\s<>\"'`\\{}|^\[\]]+")
LABEL = re.compile(r"(?:[ _-]?(?:number|no\.?|nr\.?|id|key))?[ \t]*(?::|=|#|is)?[ \t]*[\"']?", re.I)
ACCOUNT = re.compile(r"[A-Z]{0,4}[0-9][A-Z0-9]*(?:[ -][A-Z0-9]*[0-9][A-Z0-9]*)*")
SECRET_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
AUTHORITY = re.compile(r"[^/?#]*")
HEAD = re.compile(r"[A-Z]{0,4}[0-9]")
_LOWER = {c: c + 32 for c in range(65, 91)}
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?")

_auto = None


def anchors():
    """The automaton; built once a process."""
    global _auto
    if _auto is None:
        a = ahocorasick.Automaton()
        for c in "0123456789":
            a.add_word(c, ("digit", 1))
        a.add_word("@", ("at", 1))
        a.add_word("+", ("plus", 1))
        for s in ("://", "mailto:", "tel:"):
            a.add_word(s, ("scheme", len(s)))
        for kind, cues in (("account", ACCOUNT_CUES), ("secret", SECRET_CUES)):
            for cue in cues:
                a.add_word(cue, (kind, len(cue)))
        a.make_automaton()
        _auto = a
    return _auto


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def small(part: str) -> bool:
    """A decimal number of any length that is at most 255."""
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def iban(text: str) -> bool:
    s = text.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def find(text: str | None) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) in code points, by start, then kind."""
    if not text:
        return []
    out: list[tuple[str, int, int]] = []
    runs_of = Runs(text)
    email_end = dotted_end = spaced_end = phone_end = url_end = value_end = 0
    for at, (kind, k) in anchors().iter(text.lower() if text.isascii() else text.translate(_LOWER)):
        start = at - k + 1
        if kind == "digit":
            if at >= dotted_end:
                dotted_end = DOTTED.match(text, at).end()
                runs = [m.span() for m in RUN.finditer(text, at, dotted_end)]
                for i in range(0, len(runs) - 3, 4):
                    if all(small(text[a:b]) for a, b in runs[i : i + 4]):
                        out.append(("ip", runs[i][0], runs[i + 3][1]))
            if at >= spaced_end:
                m = SPACED.match(text, at)
                spaced_end = m.end() if m else at + 1
                if m and m.end() - at >= 14:
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        out.append(("card", at, m.end()))
        elif kind == "at":
            i = at
            while i > email_end and text[i - 1] in LOCAL:
                i -= 1
            if i < at and (m := DOMAIN.match(text, at + 1)):
                email_end = m.end()
                out.append(("email", i, email_end))
        elif kind == "plus":
            if at >= phone_end and text[at + 1 : at + 2] in tuple("0123456789") and (m := PLUS.match(text, at + 2)):
                last = max(m.group().rfind(c) for c in "0123456789")
                if last >= 1:
                    phone_end = m.start() + last + 1
                    if 10 <= sum("0" <= c <= "9" for c in text[at:phone_end]) <= 15:
                        out.append(("phone", at, phone_end))
        elif kind == "scheme":
            if start >= url_end and (s := _address(runs_of, start, at + 1)):
                out.append(("url", *s))
                url_end = s[1]
        elif at + 1 > value_end and not (start and text[start - 1].isalnum()) and (s := _value(runs_of, kind, at + 1)):
            out.append((kind, *s))
            value_end = s[1]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


class Runs:
    """The runs of a text's characters that anchors look at, each measured when the first of them comes."""

    def __init__(self, text: str):
        self.text = text
        self._link = self._secret = self._account = (-1, -1)
        self._mail = (-1, -1)  # where a domain was looked for, and where one begins (the text's end: nowhere)
        self._sign = (-1, -1)  # the same of an at-sign

    def link(self, at: int) -> tuple[int, list[int]]:
        """Where the link text from ``at`` on stops, and the digits of its run."""
        if not self._link[0] <= at < self._link[1]:
            m = LINK.match(self.text, at)
            end = m.end() if m else at
            stop = at + len(self.text[at:end].rstrip(".,;:!?)"))
            self._link, self._stop, self._digits = (at, end), stop, [i for i in range(at, stop) if self.text[i].isdigit()]
            self._mail = self._sign = (-1, -1)
        return self._stop, self._digits

    def sign(self, at: int, stop: int) -> int:
        """The first at-sign between ``at`` and ``stop``, the end of the link's run (-1: none)."""
        known, found = self._sign
        if not (0 <= known <= at <= found):
            found = self.text.find("@", at, stop)
            found = len(self.text) if found < 0 else found
            self._sign = (at, found)
        return found if found < stop else -1

    def has_domain(self, at: int, stop: int) -> bool:
        """Whether a domain begins between ``at`` and ``stop``, the end of the link's run."""
        known, found = self._mail
        if not (0 <= known <= at <= found):
            m = DOMAIN.search(self.text, at, stop)
            self._mail = (at, m.start() if m else len(self.text))
        return self._mail[1] < stop

    def secret(self, at: int) -> tuple[int, int] | None:
        """The run from ``at`` on, where it is long enough and has a digit and a letter."""
        if not self._secret[0] <= at < self._secret[1]:
            end = at
            while end < len(self.text) and self.text[end] in SECRET_LETTERS:
                end += 1
            last = lambda ok: next((i for i in range(end - 1, at - 1, -1) if ok(self.text[i])), -1)
            self._secret, self._last = (at, end), min(last(str.isdigit), last(str.isalpha))
        end = self._secret[1]
        return (at, end) if end - at >= 8 and self._last >= at else None

    def account(self, at: int) -> tuple[int, int] | None:
        """The number from ``at`` on, of 6 to 34 digits; it ends where that of an earlier start in the same run does."""
        head = HEAD.match(self.text, at)
        if not head:
            return None
        if not (self._account[0] <= at and head.end() <= self._account[1]):
            m = ACCOUNT.match(self.text, at)
            self._account, self._numbers = m.span(), [i for i in range(*m.span()) if self.text[i].isdigit()]
        end = self._account[1]
        return (at, end) if 6 <= len(self._numbers) - bisect_left(self._numbers, at) <= 34 else None


def _address(runs: Runs, start: int, end: int) -> tuple[int, int] | None:
    text = runs.text
    stop, digits = runs.link(end)
    if stop <= end:
        return None
    if text[start:end] == "://":
        left = start
        while left and start - left < 12 and text[left - 1].isascii() and (text[left - 1].isalnum() or text[left - 1] in "+-."):
            left -= 1
        authority = AUTHORITY.match(text, end, stop).group()
        host = authority.rpartition("@")[2].partition(":")[0].split(".")
        if left == start or not ("@" in authority or len(host) == 4 and all(h.isascii() and h.isdigit() and small(h) for h in host)):
            return None
        return left, stop
    if text[start:end].lower() == "mailto:":
        sign = runs.sign(end, stop)
        good = sign >= 0 and runs.has_domain(sign + 1, stop)
    else:
        good = 7 <= len(digits) - bisect_left(digits, end) <= 15
    return (start, stop) if good else None


def _value(runs: Runs, kind: str, end: int) -> tuple[int, int] | None:
    at = LABEL.match(runs.text, end).end()
    if kind == "secret":
        return runs.secret(at)
    if m := IBAN.match(runs.text, at):
        if iban(m.group()):
            return m.span()
    return runs.account(at)


def brute_force(text: str | None) -> list[tuple[str, int, int]]:
    """For tests: the base patterns run over the whole text."""
    t, out = text or "", []
    for kind, pattern in BASE.items():
        for m in pattern.finditer(t):
            digits = re.sub(r"[^0-9]", "", m.group())
            ok = kind == "email" or kind == "ip" and all(small(p) for p in m.group().split(".")) or kind == "card" and 14 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 10 <= len(digits) <= 15
            if ok:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


SPANS = "array<struct<kind:string,start:long,end:long>>"


def as_rows(text: str | None) -> list[dict]:
    return [{"kind": k, "start": a, "end": b} for k, a, b in find(text)]


def detect(documents: DataFrame, *, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Every row (struct ``row``) with its spans."""
    return documents.select(row_of(documents, carry), F.udf(as_rows, SPANS, useArrow=True)(F.col(text_col).cast("string")).alias("spans"))


def redact(documents: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The documents with each span (overlaps: the one that begins first) replaced by its kind in brackets."""

    return documents.withColumn(text_col, F.udf(mask, "string", useArrow=True)(F.col(text_col).cast("string")))


def mask(text: str | None) -> str | None:
    if text is None:
        return None
    out, at = [], 0
    for kind, a, b in find(text):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
            at = b
    return "".join([*out, text[at:]])


def digest(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count(kind: str):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
