"""Personal data in plain and disguised spelling, with places in the original text.

A transducer rewrites look-alike letters and digits, invisible characters, spelled digits and written-out at and dot
signs, and remembers which source characters each written character stands for. The detectors run on both texts; what
they find in the rewritten one is mapped back.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshlark.llm import common

KINDS = ("email", "ip", "card", "phone")
SPAN_TYPE = "array<struct<kind: string, start: long, stop: long, base: boolean>>"

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match that begins inside a run of digits could not succeed where the run's start failed.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each at sign: the run of local characters before it, as far as the last match, and the domain after."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            done = match.end()
        at = text.find("@", max(at + 1, done))


def _digits(match: re.Match) -> str:
    return "".join(_DIGIT.findall(match[0]))


def detect(text: str) -> list[tuple[str, int, int]]:
    """All plain identifiers, by kind as listed in ``KINDS``, then by place."""
    found = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            found += [("ip", m.start(), m.end()) for m in _IP.finditer(text)
                      if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = _digits(m)
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", m.start(), m.end()))
        if "+" in text:
            found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m)) <= 15]
    return found


# Letters of other scripts that look like the Latin ones beside them.
_LOOK_ALIKE = dict(zip(
    "аеорсухіјѕԁԛԝһӏАВЕКМНОРСТХІЈЅУαοριντυκΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
    "aeopcyxijsdqwhlABEKMHOPCTXIJSYaopivtukABEZHIKMNOPTYX"))
_SIGNS = {"＠": "@", "﹫": "@", "․": ".", "。": ".", "｡": ".", "．": ".", "·": ".", "‐": "-", "‑": "-", "‒": "-",
          "–": "-", "−": "-", "﹣": "-", "＋": "+", "﹢": "+", " ": " ", " ": " ", " ": " "}
_INVISIBLE = "­​‌‍⁠﻿"
_SPELLED = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
            "eight": "8", "nine": "9"}


@lru_cache(maxsize=4096)
def plain_character(c: str) -> str:
    """What a character stands for: its look-alike, its digit value, its compatibility form, or itself."""
    if c in _INVISIBLE:
        return ""
    if c in _LOOK_ALIKE or c in _SIGNS:
        return _LOOK_ALIKE.get(c) or _SIGNS[c]
    digit = unicodedata.digit(c, None)
    if digit is not None:
        return str(digit)
    form = unicodedata.normalize("NFKC", c)
    return form if len(form) == 1 and form.isascii() else c


_ODD = re.compile(r"[^\x00-¬®-±´-¶¸»-ſ‘-‟…]|[­ ·²³¹]")
_OPEN, _CLOSE = r"[ \t]*[(\[{<][ \t]*", r"[ \t]*[)\]}>][ \t]*"
_WORD = "|".join(_SPELLED)
_AT = re.compile(rf"{_OPEN}at{_CLOSE}|(?<=[A-Za-z0-9])[ \t]+at[ \t]+(?=[A-Za-z0-9-]+(?:[ \t]+dot[ \t]+|{_OPEN}dot{_CLOSE}|\.)"
                 rf"[A-Za-z0-9])|(?<=[A-Za-z0-9])[_-]at[_-](?=[A-Za-z0-9-]+(?:[_-]dot[_-]|\.)[A-Za-z0-9])", re.I)
_DOT = re.compile(rf"(?<=[A-Za-z0-9]){_OPEN}(?:dot|\.){_CLOSE}(?=[A-Za-z0-9])|(?<=[A-Za-z0-9])(?:[ \t]+|[_-])(?:dot|point)"
                  rf"(?:[ \t]+|[_-])(?=[A-Za-z0-9])", re.I)
_RUN = re.compile(rf"(?:\bplus[ \t,-]*)?(?<![A-Za-z])(?:{_WORD}|[0-9]+)(?:[ \t,.-]{{1,3}}(?:{_WORD}|[0-9]+)(?![A-Za-z0-9])){{2,}}", re.I)
_PART = re.compile(rf"plus|{_WORD}|[0-9]+", re.I)
_TWO_SPELLED = re.compile(rf"(?<![A-Za-z])(?:{_WORD})(?![A-Za-z])", re.I)
_HINT = re.compile(rf"[(\[{{<][ \t]*(?:at|dot|\.)[ \t]*[)\]}}>]|[ \t_-](?:at|dot|point)[ \t_-]|(?<![A-Za-z])(?:{_WORD})(?![A-Za-z])", re.I)


class Rewritten:
    """A text in rewriting: its characters and, for each, the source stretch it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.start = list(range(len(text)))
        self.stop = list(range(1, len(text) + 1))
        self.changed = [False] * len(text)

    def replace(self, pattern: re.Pattern, new: Callable[[re.Match], list[tuple[int, int, str]]]) -> None:
        """``new`` lists ``(from, to, written)`` for stretches of a match that are written anew; each character of
        ``written`` stands for the whole stretch."""
        text, start, stop, changed, last = [], [], [], [], 0
        for match in pattern.finditer(self.text):
            for a, b, written in new(match):
                text += [self.text[last:a], written]
                start += self.start[last:a] + [self.start[a]] * len(written)
                stop += self.stop[last:a] + [self.stop[b - 1]] * len(written)
                changed += self.changed[last:a] + [True] * len(written)
                if not written:  # something has gone here: the next character and the one before are next to a change
                    for side in (changed,):
                        if side:
                            side[-1] = True
                last = b
        if last:
            self.text = "".join([*text, self.text[last:]])
            self.start = start + self.start[last:]
            self.stop = stop + self.stop[last:]
            self.changed = changed + self.changed[last:]


def _letters(match: re.Match) -> list[tuple[int, int, str]]:
    plain = plain_character(match[0])
    return [(match.start(), match.end(), plain)] if plain != match[0] else []


def _digits_of_run(match: re.Match) -> list[tuple[int, int, str]]:
    """Spelled digits become digits and lose the blanks between them; runs of digits alone stay as they are."""
    if len(_TWO_SPELLED.findall(match[0])) < 2:
        return []
    out, last = [], None
    for part in _PART.finditer(match[0]):
        a, b = match.start() + part.start(), match.start() + part.end()
        if last is not None and a > last:
            dotted = "." in match[0][last - match.start():a - match.start()]
            out.append((last, a, "." if dotted else ""))
        word = part[0].lower()
        if not word.isdigit():
            out.append((a, b, "+" if word == "plus" else _SPELLED[word]))
        last = b
    return out


def rewrite(text: str) -> Rewritten | None:
    """The text without disguises, or nothing where there is no sign of any."""
    odd, hint = _ODD.search(text), _HINT.search(text)
    if not odd and not hint:
        return None
    now = Rewritten(text)
    if odd:
        now.replace(_ODD, _letters)
    now.replace(_AT, lambda m: [(m.start(), m.end(), "@")])
    now.replace(_DOT, lambda m: [(m.start(), m.end(), ".")])
    now.replace(_RUN, _digits_of_run)
    return now if True in now.changed else None


def find(text: str) -> list[tuple[str, int, int, bool]]:
    """``(kind, start, stop, base)`` in code points, by kind and place. Spans that only the rewritten text shows are
    added to the plain ones, unless a plain one of their kind holds them."""
    base = detect(text)
    found = [(*span, True) for span in base]
    now = rewrite(text)
    if now is not None:
        for kind, a, b in detect(now.text):
            if True in now.changed[a:b]:
                start, stop = now.start[a], now.stop[b - 1]
                if not any(k == kind and s <= start and stop <= e for k, s, e in base):
                    found.append((kind, start, stop, False))
    return sorted(set(found), key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _spans(text_at: int, redacted: bool):
    """Add the spans, or put placeholders into the text."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_())]))
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                texts = part.column(text_at).to_pylist()
                columns = list(part.columns)
                if redacted:
                    columns[text_at] = pa.array([None if t is None else _redact(t) for t in texts], batch.schema.field(text_at).type)
                    yield pa.RecordBatch.from_arrays(columns, batch.schema.names)
                else:
                    spans = [[dict(zip(("kind", "start", "stop", "base"), s)) for s in find(t or "")] for t in texts]
                    columns[text_at] = pa.array(spans, kind)
                    names = [n if i != text_at else "spans" for i, n in enumerate(batch.schema.names)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return kernel


def _redact(text: str) -> str:
    out, last = [], 0
    for start, kind, stop in sorted((s, k, e) for k, s, e, _ in find(text)):
        if start >= last:
            out += [text[last:start], f"[{kind.upper()}]"]
        last = max(last, stop)
    return "".join([*out, text[last:]])


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, spans`` for each row of ``docs`` (columns ``doc_id``, ``text``): kind, start, stop (code points, stop
    excluded) and whether the plain spelling shows it. Null and empty texts have no spans; repeated rows and equal
    texts have equal ones. Text stays where it is: there is no shuffle."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _spans(1, False), f"doc_id long, spans {SPAN_TYPE}")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each found stretch of ``text`` replaced by its kind in brackets, and ``n_chars``, if there, set to
    the new length. Overlapping finds become one placeholder, that of the first. Null texts stay null."""
    changed = docs.mapInArrow(_spans(docs.columns.index("text"), True), docs.schema)
    if "n_chars" in docs.columns:
        length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
        changed = changed.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return changed


def joined(spans: Column) -> Column:
    """``kind:start:stop`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
