"""Personal data: base patterns, and a deobfuscation that keeps source offsets.

Each transducer rewrites disguised characters (homoglyphs, at / dot disguises, spelled digits)
and records its edits. Identifiers are detected on the rewritten text; a span found there that
rests on at least one edit is mapped back through the edits to characters of the source.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlattice.llm.common import col, fresh, row_type, span_string

KINDS = ("email", "ip", "card", "phone")
ORDER = {kind: n for n, kind in enumerate(KINDS)}
Span = tuple[str, int, int]

LOCAL_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
# Possessive runs and a look-behind keep every scan linear; no match changes by them, as the
# character after a run can never be part of the run.
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")

#: Letters of other scripts that look like a Latin one. Fixed values; compatibility forms come by rule.
LOOKALIKES = dict(zip("АВЕКМНОРСТХаеорсухіјѕΑΒΕΖΗΙΚΜΝΟΡΤΥΧο", "ABEKMHOPCTXaeopcyxijsABEZHIKMNOPTYXo", strict=True))
INVISIBLE = "­​‌‍⁠﻿"
#: Digit words by value, in the corpus languages. Fixed values.
DIGIT_WORDS = (("zero", "null", "zéro", "cero"), ("one", "eins", "un", "uno"), ("two", "zwei", "deux", "dos"),
               ("three", "drei", "trois", "tres"), ("four", "vier", "quatre", "cuatro"),
               ("five", "fünf", "cinq", "cinco"), ("six", "sechs", "seis"), ("seven", "sieben", "sept", "siete"),
               ("eight", "acht", "huit", "ocho"), ("nine", "neun", "neuf", "nueve"))
DIGIT_OF = {word: str(n) for n, group in enumerate(DIGIT_WORDS) for word in group}

STRANGE = re.compile("[" + "".join(LOOKALIKES) + INVISIBLE
                     + "․。‐-―①-⑨Ⓐ-⓪﹒﹫！-～｡\U0001d400-\U0001d7ff]")
# Blanks before a bracket are taken from the start of their run alone, so a long run is passed once.
_before, _after = r"(?i)(?:(?<![ \t])[ \t]++)?[\[({<][ \t]*+", r"[ \t]*+[\])}>][ \t]*+"
AT = re.compile(rf"{_before}(?:at|@){_after}")
DOT = re.compile(rf"{_before}(?:dot|\.){_after}")
#: Plain words count only as the whole "name at host dot domain", the last word a usual top-level domain. Fixed values.
TOP_LEVEL = frozenset("com org net edu gov info biz io co ai app dev me eu uk de fr es it nl ch at be pl us ca au in jp cn br ru".split())
SPOKEN = re.compile(r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+([ \t]+at[ \t]+)[A-Za-z0-9-]+((?:[ \t]+dot[ \t]+[A-Za-z0-9-]+)+)")
SPOKEN_DOT = re.compile(r"(?i)[ \t]+dot[ \t]+")
DISGUISED = re.compile(r"(?i)[\[({<][ \t]*(?:at|@|dot|\.)[ \t]*[\])}>]|[ \t]at[ \t]++[A-Za-z0-9-]++[ \t]++dot[ \t]")
_word = "|".join(sorted(DIGIT_OF, key=len, reverse=True))
#: Five digit words or more in a row, so that number words of prose stay words.
SPELLED = re.compile(rf"(?i)(?<!\w)(?:(?:{_word})(?:[ \t,.-]{{1,3}}(?={_word})|(?!\w))){{5,}}")
SPELLED_WORD = re.compile(rf"(?i)(?:{_word})")


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if n % 2 == 0 else (v * 2 - 9 if v > 4 else v * 2)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, leftmost and without overlap within a kind, ordered by start and kind."""
    out: list[Span] = []
    if "@" in text:
        last = 0
        for m in DOMAIN.finditer(text):
            before = text[last:m.start()]
            local = len(before) - len(before.rstrip(LOCAL_CHARS))
            if local:
                out.append(("email", m.start() - local, m.end()))
                last = m.end()
            else:
                last = m.start() + 1
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], ORDER[s[0]]))


class Edits:
    """A rewritten text and the way back to source offsets."""

    def __init__(self, text: str, edits: list[tuple[int, int, str]]):
        parts, at, size = [], 0, 0
        self.starts, self.ends, self.source = [], [], []
        for start, end, new in edits:
            parts += [text[at:start], new]
            size += start - at
            self.starts.append(size)
            size += len(new)
            self.ends.append(size)
            self.source.append((start, end))
            at = end
        parts.append(text[at:])
        self.text = "".join(parts)

    def start(self, p: int) -> int:
        n = bisect_right(self.starts, p) - 1
        if n < 0:
            return p
        return self.source[n][0] if p < self.ends[n] else self.source[n][1] + p - self.ends[n]

    def end(self, p: int) -> int:
        return self.start(p - 1) + 1 if not self.inside(p - 1) else self.source[bisect_right(self.starts, p - 1) - 1][1]

    def inside(self, p: int) -> bool:
        n = bisect_right(self.starts, p) - 1
        return n >= 0 and p < self.ends[n]


def plain_char(c: str) -> str:
    if c in INVISIBLE:
        return ""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if "‐" <= c <= "―":
        return "-"
    if c in "。｡":
        return "."
    k = unicodedata.normalize("NFKC", c)
    return k if len(k) == 1 and k.isascii() else c


def homoglyphs(text: str) -> list[tuple[int, int, str]]:
    if text.isascii():
        return []
    return [(m.start(), m.end(), new) for m in STRANGE.finditer(text) if (new := plain_char(m[0])) != m[0]]


def disguises(text: str) -> list[tuple[int, int, str]]:
    if not DISGUISED.search(text):
        return []
    found = [(*m.span(), "@") for m in AT.finditer(text)] + [(*m.span(), ".") for m in DOT.finditer(text)]
    for m in SPOKEN.finditer(text):
        if m[2].split()[-1].lower() not in TOP_LEVEL:
            continue
        found.append((*m.span(1), "@"))
        found += [(m.start(2) + d.start(), m.start(2) + d.end(), ".") for d in SPOKEN_DOT.finditer(m[2])]
    out, last = [], 0
    for edit in sorted(found):
        if edit[0] >= last:
            out.append(edit)
            last = edit[1]
    return out


def spelled_digits(text: str) -> list[tuple[int, int, str]]:
    """One edit for each digit word together with the separator behind it."""
    parts = text.lower().replace(",", " ").replace(".", " ").replace("-", " ").split()
    if DIGIT_OF.keys().isdisjoint(parts) or b"\1" * 5 not in bytes(map(DIGIT_OF.__contains__, parts)):
        return []
    out = []
    for run in SPELLED.finditer(text):
        marks = list(SPELLED_WORD.finditer(text, run.start(), run.end()))
        for m, after in zip(marks, [*marks[1:], None]):
            out.append((m.start(), after.start() if after else m.end(), DIGIT_OF[m[0].lower()]))
    return out


TRANSDUCERS = (homoglyphs, disguises, spelled_digits)


def all_spans(text: str, base: list[Span]) -> list[Span]:
    """Base spans plus those that only the rewritten text shows. An added span overlaps no base span."""
    chain, now = [], text
    for rewrite in TRANSDUCERS:
        if edits := rewrite(now):
            chain.append(Edits(now, edits))
            now = chain[-1].text
    if not chain:
        return base
    added, taken = [], []
    for _, start, end in base:  # ordered by start; what overlaps or touches is one stretch
        if taken and start <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([start, end])
    starts = [start for start, _ in taken]
    for kind, start, end in base_spans(now):
        a, b, changed = start, end, False
        for step in reversed(chain):
            n = bisect_right(step.starts, b - 1) - 1
            changed |= n >= 0 and (step.starts[n] >= a or step.ends[n] > a)
            a, b = step.start(a), step.end(b)
        last = bisect_left(starts, b) - 1  # the last stretch that starts before the span ends
        if changed and not (last >= 0 and taken[last][1] > a):
            added.append((kind, a, b))
    return sorted(base + added, key=lambda s: (s[1], ORDER[s[0]]))


def masked(text: str, spans: list[Span]) -> str:
    """Each group of overlapping spans becomes one placeholder, named by its first kind."""
    out, at, open_span = [], 0, None
    for kind, start, end in [*spans, ("", len(text) + 1, len(text) + 1)]:
        if open_span and start < open_span[2]:
            open_span = (*open_span[:2], max(open_span[2], end))
            continue
        if open_span:
            out += [text[at:open_span[1]], f"[{open_span[0].upper()}]"]
            at = open_span[2]
        open_span = (kind, start, end)
    return "".join([*out, text[at:]])


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, masked string"


def _found(text: str | None) -> tuple:
    text = text or ""
    base = base_spans(text)
    spans = all_spans(text, base)
    counts = [sum(s[0] == kind for s in base) for kind in KINDS]
    return (*counts, hashlib.sha256(span_string(base).encode()).hexdigest(), span_string(spans), masked(text, spans))


@F.pandas_udf(row_type(FOUND))
def find_in(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    names = [field.split()[0] for field in FOUND.split(", ")]
    for texts in batches:
        yield pd.DataFrame([_found(t) for t in texts], columns=names)


def find_personal(docs: DataFrame, text: str = "text", out: str = "personal") -> DataFrame:
    """The frame with one more column, a struct: counts of base spans by kind, their digest, all spans, masked text.

    Null text counts as empty. Every row, whatever its other columns, gives one row; ``out`` is renamed
    with a number where the frame already has such a column (the last column is always the struct).
    Offsets are code points, the end exclusive. Counts and digest cover the base patterns, ``spans`` also
    what the deobfuscation adds.
    """
    return docs.withColumn(fresh(docs, out)[0], find_in(col(text)))


def mask_personal(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same columns, with every span in the text replaced by its kind in brackets. Null text stays null."""
    found = find_personal(docs, text)
    struct = found.columns[-1]
    masked_text = F.when(col(text).isNotNull(), F.col(f"`{struct}`.masked"))
    return found.select(*[masked_text.alias(c) if c == text else col(c) for c in docs.columns])
