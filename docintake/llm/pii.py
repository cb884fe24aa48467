"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, URL schemes
and identifier cues. Local parsers expand each anchor to its boundaries and validate it.

Base kinds, with the spans their patterns would match from left to right without overlap
(per kind; a match that fails its check is dropped and not tried again):

- email: ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
- ip: ``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)``, each part at most 255
- card: ``[0-9]([\\x20-]?[0-9])+`` with 16 to 19 digits and a valid Luhn sum
- phone: ``\\+[0-9][\\x20().0-9-]+[0-9]`` with 8 to 15 digits

Added kinds:

- address: a URL's scheme and authority where the authority names a user (``user@host``), and
  what follows ``mailto:`` or ``tel:``
- account: the value after a cue such as ``password =``, ``"token":``, ``IBAN`` or ``account no.``,
  in any case. All cues but ``IBAN`` and ``Bearer`` are common words and need ``=``, ``:``, ``#`` or
  a word for number after them; each asks for a length and a number of digits (``CUES``). An
  IBAN must pass its check sum. Access keys with a known beginning and length need no cue.

Anchors are looked for in the text with A-Z in lower case, which has the same positions.
Positions are code points, ends exclusive. Null and empty texts have no spans. Rows are read
one by one, whatever repeats; an empty table gives an empty one; texts of any length are whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "address", "account")
SCHEMES = ("://", "mailto:", "tel:")
#: Cue: (shortest value, fewest digits in it).
CUES = {
    **dict.fromkeys(("password", "passwd", "pwd", "passcode", "passphrase"), (6, 1)),
    **dict.fromkeys(("api_key", "apikey", "api-key", "api key", "access_key", "access key"), (8, 1)),
    **dict.fromkeys(("secret", "secret_key", "private_key", "client_secret"), (8, 1)),
    **dict.fromkeys(("token", "access_token", "auth_token", "bearer"), (16, 1)),
    **dict.fromkeys(("account", "acct", "passport", "ssn", "tax id"), (6, 4)),
    "iban": (15, 2),
}
LONGEST_VALUE = 512
#: Beginnings of access keys and how many letters and digits follow.
KEYS = {"AKIA": 16, "ASIA": 16, "AIza": 35, "ghp_": 36, "gho_": 36, "ghs_": 36}

_DIGITS = frozenset("0123456789")
_ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | _DIGITS
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_VALUE = _ALNUM | frozenset("_-")
_SECRET = _VALUE | frozenset("./+=~$!@%^&*")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_PHONE = _DIGITS | frozenset(" ().-")
_CLUSTER = frozenset(" .-")

Span = tuple[str, int, int]


def _run(text: str, at: int, allowed: frozenset) -> int:
    """End of the run of allowed characters that begins at ``at``."""
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if k % 2:
            v = 2 * v - 9 * (v > 4)
        total += v
    return total % 10 == 0


def iban_valid(value: str) -> bool:
    moved = (value[4:] + value[:4]).upper()
    return moved.isalnum() and moved.isascii() and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


class _Parsers:
    """Spans of one text; anchors are given from left to right."""

    def __init__(self, text: str):
        self.text = text
        self.spans: list[Span] = []
        self.email_end = self.phone_end = self.number_end = self.address_end = 0

    def at_sign(self, at: int) -> None:
        text = self.text
        start = at
        while start > self.email_end and text[start - 1] in _LOCAL:
            start -= 1
        if start == at:
            return
        end = _run(text, at + 1, _LABEL)
        if end == at + 1:
            return
        labels = 0
        while end < len(text) and text[end] == ".":
            stop = _run(text, end + 1, _LABEL)
            if stop == end + 1:
                break
            end, labels = stop, labels + 1
        if labels:
            self.spans.append(("email", start, end))
            self.email_end = end

    def plus(self, at: int) -> None:
        text = self.text
        if at < self.phone_end or at + 1 >= len(text) or text[at + 1] not in _DIGITS:
            return
        end = _run(text, at + 2, _PHONE)
        while end > at + 3 and text[end - 1] not in _DIGITS:
            end -= 1
        if end <= at + 3:  # a digit, something between, a digit
            return
        self.phone_end = end
        if 8 <= sum(c in _DIGITS for c in text[at:end]) <= 15:
            self.spans.append(("phone", at, end))

    def digit(self, at: int) -> None:
        """Numbers, joined by single spaces, hyphens and dots, from their first digit on."""
        if at < self.number_end:
            return
        text, n = self.text, len(self.text)
        runs = []  # (start, end, what joins it to the run before)
        joint = ""
        while True:
            end = _run(text, at, _DIGITS)
            runs.append((at, end, joint))
            if end + 1 < n and text[end] in _CLUSTER and text[end + 1] in _DIGITS:
                joint, at = text[end], end + 1
            else:
                break
        self.number_end = runs[-1][1]
        self._ips(runs)
        self._cards(runs)

    def _ips(self, runs) -> None:
        chain = []
        for run in runs:
            chain = [*chain, run] if chain and run[2] == "." else [run]
            if len(chain) == 4:
                parts = [self.text[a:b].lstrip("0") for a, b, _ in chain]
                if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                    self.spans.append(("ip", chain[0][0], chain[3][1]))
                chain = []

    def _cards(self, runs) -> None:
        first = 0
        for k in range(1, len(runs) + 1):
            if k < len(runs) and runs[k][2] != ".":
                continue
            digits = sum(b - a for a, b, _ in runs[first:k])
            if 16 <= digits <= 19:
                number = "".join(self.text[a:b] for a, b, _ in runs[first:k])
                if luhn(number):
                    self.spans.append(("card", runs[first][0], runs[k - 1][1]))
            first = k

    def scheme(self, at: int, end: int) -> None:
        text, mark = self.text, self.text[at:end].lower()
        if at < self.address_end:
            return
        stop = end
        while stop < len(text) and not text[stop].isspace() and text[stop] not in "/?#\"'<>()[]":
            stop += 1
        while stop > end and text[stop - 1] in ".,;:!":
            stop -= 1
        if mark == "://":
            user, sign, host = text[end:stop].rpartition("@")
            start = at
            while start and text[start - 1] in _ALNUM:
                start -= 1
            good = sign and user and "." in host.strip(".") and start < at
        elif mark == "mailto:":
            user, sign, host = text[end:stop].partition("@")
            start, good = at, sign and user and "." in host.strip(".")
        else:
            start, good = at, sum(c in _DIGITS for c in text[end:stop]) >= 7
        if good:
            self.spans.append(("address", start, stop))
            self.address_end = stop

    def cue(self, at: int, end: int) -> None:
        text, word = self.text, self.text[at:end].lower()
        if at and text[at - 1] in _ALNUM:
            return  # inside another word
        stop, marked = end, word in ("iban", "bearer")
        for more in (" number", " no.", " no", " id"):
            if text[stop : stop + len(more)].lower() == more:
                stop, marked = stop + len(more), True
                break
        mark = stop
        while stop < len(text) and text[stop] in " \t=:#>\"'`" and stop - mark < 8:
            marked |= text[stop] in "=:#"
            stop += 1
        if stop == mark or not marked:
            return
        if word == "iban":
            close = _run(text, stop, _VALUE)
            while close + 1 < len(text) and text[close] == " " and text[close + 1] in _DIGITS:
                close = _run(text, close + 1, _VALUE)  # may be written in groups of four
            value = text[stop:close].replace(" ", "")
            good = 15 <= len(value) <= 34 and value[:2].isalpha() and iban_valid(value)
        else:
            shortest, digits = CUES[word]
            numeric = digits > 1
            close = _run(text, stop, _VALUE if numeric else _SECRET)
            while close > stop and text[close - 1] in ".!":
                close -= 1  # the end of a sentence
            value = text[stop:close]
            good = shortest <= len(value) <= (64 if numeric else LONGEST_VALUE)
            good = good and sum(c in _DIGITS for c in value) >= digits and "://" not in value
        if good:
            self.spans.append(("account", stop, close))

    def key(self, at: int, end: int) -> None:
        text = self.text
        length = KEYS.get(text[at:end])
        if length and not (at and text[at - 1] in _ALNUM) and _run(text, end, _VALUE) == end + length:
            self.spans.append(("account", at, end + length))


def automaton():
    """Aho-Corasick automaton of the anchors; a match gives (kind of anchor, its length)."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for c in "@+0123456789":
        found.add_word(c, (c, 1))
    for mark in SCHEMES:
        found.add_word(mark, ("scheme", len(mark)))
    for cue in CUES:
        found.add_word(cue, ("cue", len(cue)))
    for beginning in KEYS:
        found.add_word(beginning.lower(), ("key", len(beginning)))
    found.make_automaton()
    return found


def find(text: str, anchors) -> list[Span]:
    """Spans (kind, start, end) by kind as listed, then start."""
    parsers = _Parsers(text)
    lower = text.encode("utf-8").translate(_LOWER).decode("utf-8")
    for last, (kind, length) in anchors.iter(lower):
        if kind == "@":
            parsers.at_sign(last)
        elif kind == "+":
            parsers.plus(last)
        elif kind == "scheme":
            parsers.scheme(last + 1 - length, last + 1)
        elif kind == "cue":
            parsers.cue(last + 1 - length, last + 1)
        elif kind == "key":
            parsers.key(last + 1 - length, last + 1)
        elif last >= parsers.number_end:
            parsers.digit(last)
    return sorted(set(parsers.spans), key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def redact(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind in brackets; overlapping spans are one."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
            at = end
        elif end > at:  # overlaps the one before: its rest goes with it
            at = end
    return "".join([*out, text[at:]])


SPANS = ArrayType(
    StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())])
)
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def spans(docs: DataFrame, name: str = "spans", text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with column ``name``, its spans (a new name); ``text`` is redacted, or dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton()
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                at = part.schema.get_field_index(text)
                field, texts = part.schema.field(at), part.column(at).to_pylist()
                found = [find(t, anchors) if t else [] for t in texts]
                if keep_text:
                    clean = [redact(t, s) if s else t for t, s in zip(texts, found)]
                    part = part.set_column(at, field, pa.array(clean, field.type))
                else:
                    part = part.drop_columns([text])
                rows = [[dict(zip(("kind", "start", "end"), s)) for s in row] for row in found]
                yield part.append_column(name, pa.array(rows, _SPANS))

    kept = [f for f in docs.schema.fields if keep_text or f.name != text]
    return docs.mapInArrow(run, StructType([*kept, StructField(name, SPANS)]))


def joined(found):
    """Column of ``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
