"""Personal data in plain and in disguise, as spans of the original text.

Transducers undo disguises step by step: look-alike characters, spelled digits, "at" and "dot" written out. Each step keeps, for
every character it writes, where that character came from; identifiers found in the result are mapped back.
"""

from __future__ import annotations

import re
import string
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

KINDS = ["email", "ip", "card", "phone"]

# The plain forms of identifiers. An address is found from its @, a number from the start of a run of
# digits; both give the leftmost matches of the full patterns in linear time.
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters of other scripts that look like Latin ones, then dashes, dots and signs.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "υ": "u", "χ": "x", "ϲ": "c",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "ɑ": "a", "ɡ": "g",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "․": ".", "。": ".", "﹫": "@", "﹒": ".", "﹢": "+", " ": " ", " ": " ",
}
#: Characters that show nothing: zero widths, joiners, soft hyphen, byte order mark.
INVISIBLE = "​‌‍⁠﻿­"

# Digits as words in the languages of the corpus.
SPELLED = [
    "zero one two three four five six seven eight nine".split(),
    "null eins zwei drei vier fünf sechs sieben acht neun".split(),
    "zéro un deux trois quatre cinq six sept huit neuf".split(),
    "cero uno dos tres cuatro cinco seis siete ocho nueve".split(),
]
DIGIT_OF = {word: str(d) for words in SPELLED for d, word in enumerate(words)}
#: So many digit words in a row are a number; fewer are prose, unless figures stand beside them.
LEAST_WORDS = 3
# Domain ends after which a written-out "at" is an address, though no dot of the host is written out.
DOMAIN_ENDS = "com org net edu gov info io co biz de fr es uk eu us ch at it nl example test".split()

#: After the word "at" these begin prose, not a host: "look at this dot matrix".
DETERMINERS = frozenset("a an the this that these those my your his her its our their each every any some no which what".split())

DOT_WORDS = "dot|punkt|point|punto"
_words = "|".join(sorted(DIGIT_OF, key=len, reverse=True))
_gap = rf"(?:[\x20\t-]{{1,3}}|[\x20\t](?:{DOT_WORDS})[\x20\t])"
SPELLED_RUN = re.compile(rf"\b(?:plus{_gap})?(?:{_words})\b(?:{_gap}(?:{_words})\b){{{LEAST_WORDS - 1},}}", re.I)
# Shorter runs count beside figures: after or before one with a written dot between, between two, or after a plus.
_run = rf"(?:{_words})\b(?:{_gap}(?:{_words})\b){{0,{LEAST_WORDS - 2}}}"
_dot = rf"[\x20\t](?:{DOT_WORDS})[\x20\t]"
SPELLED_NEAR = re.compile(rf"(?<=[0-9]){_dot}({_run})|(?<=[0-9])[\x20\t-]({_run})(?=[\x20\t-][0-9])|(?<=\+)({_run})|\b({_run})(?={_dot}[0-9])", re.I)
SPELLED_WORD = re.compile(rf"\bplus\b|\b(?:{_words})\b", re.I)
BRACKETED = re.compile(rf"[\[({{<]\s?(at|arroba|@|{DOT_WORDS}|\.)\s?[\])}}>]", re.I)
AT = re.compile(r"[A-Za-z0-9._%+-][\x20\t](?=at|arroba)", re.I)
HOST = re.compile(
    rf"(?:at|arroba)[\x20\t]((?:[A-Za-z0-9-]{{1,63}}(?:[\x20\t](?:{DOT_WORDS})[\x20\t]|\.))+(?:{'|'.join(DOMAIN_ENDS)}))\b", re.I
)
_host = rf"[A-Za-z0-9-]{{1,63}}(?:(?:[\x20\t](?:{DOT_WORDS})[\x20\t]|\.)[A-Za-z0-9-]{{1,63}})*"
_end = rf"(?:[\x20\t](?:{DOT_WORDS})[\x20\t]|\.)(?:[A-Za-z]{{2,63}}|xn--[A-Za-z0-9-]{{1,59}})(?![A-Za-z0-9-])"
ANY_HOST = re.compile(rf"(at|arroba)[\x20\t]({_host}{_end})", re.I)
AFTER_SIGN = re.compile(rf"(?<=[A-Za-z0-9._%+-])@[A-Za-z0-9-]+(?:(?:[\x20\t](?:{DOT_WORDS})[\x20\t]|\.)[A-Za-z0-9-]+)+", re.I)
WRITTEN_DOT = re.compile(rf"[\x20\t](?:{DOT_WORDS})[\x20\t]", re.I)
NUMBER_DOT = re.compile(rf"(?<=[0-9])[\x20\t](?:{DOT_WORDS})[\x20\t](?=[0-9])", re.I)
DOTS, NAMES_AT = frozenset(DOT_WORDS.split("|")), frozenset(["at", "arroba"])
#: A text without any of these is what the transducers leave as it is. Fullwidth forms and foreign digits come by range.
_classes = "".join(re.escape(c) for c in [*LOOK_ALIKES, *INVISIBLE]) + "！-～" + "٠-٩۰-۹०-९০-৯๐-๙"
ODD = re.compile(f"[{_classes}]")


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Where addresses start and end. From each @ the name is walked back, to the last address or @ at most."""
    end = 0
    for found in DOMAIN.finditer(text):
        start = found.start()
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < found.start():
            yield start, found.end()
            end = found.end()


def luhn(digits: str) -> bool:
    doubled = [int(d) for d in digits[-2::-2]]
    return (sum(int(d) for d in digits[-1::-2]) + sum(2 * d - 9 if d > 4 else 2 * d for d in doubled)) % 10 == 0


def plain(text: str) -> list[tuple[str, int, int]]:
    """The identifiers of the plain patterns as (kind, start, end), by start, then kind; matches of a kind do not overlap."""
    out = []
    if "@" in text:
        out += [("email", a, b) for a, b in addresses(text)]
    for found in IP.finditer(text):
        # a long part is too large, whatever its digits; int() of very long text would be slow
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in found.group().split(".")):
            out.append(("ip", *found.span()))
    for found in CARD.finditer(text):
        if found.end() - found.start() >= 12 and found.end() - found.start() <= 37:
            digits = re.sub("[^0-9]", "", found.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *found.span()))
    if "+" in text:
        for found in PHONE.finditer(text):
            if 9 <= len(re.sub("[^0-9]", "", found.group())) <= 15:
                out.append(("phone", *found.span()))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


@dataclass
class Mapped:
    """A text, and for each character the span of the original that it stands for."""

    text: str
    start: np.ndarray
    end: np.ndarray

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Mapped:
        """With non-overlapping pieces replaced, in order. Each new character stands for its whole piece."""
        if not edits:
            return self
        text, start, end, at = [], [], [], 0
        for a, b, new in edits:
            text += [self.text[at:a], new]
            start += [self.start[at:a], np.full(len(new), self.start[a])]
            end += [self.end[at:a], np.full(len(new), self.end[b - 1])]
            at = b
        return Mapped("".join([*text, self.text[at:]]), np.concatenate([*start, self.start[at:]]), np.concatenate([*end, self.end[at:]]))


def look_alikes(m: Mapped) -> list[tuple[int, int, str]]:
    out = []
    for found in ODD.finditer(m.text):
        c = found.group()
        digit = unicodedata.decimal(c, None)
        wide = chr(ord(c) - 0xFEE0) if "！" <= c <= "～" else ""
        out.append((found.start(), found.end(), "" if c in INVISIBLE else str(digit) if digit is not None else wide or LOOK_ALIKES[c]))
    return out


def spelled_digits(m: Mapped) -> list[tuple[int, int, str]]:
    """Each word becomes its digit; what lies between the words of a run goes, but for a written dot."""
    runs = [run.span() for run in SPELLED_RUN.finditer(m.text)]
    runs += [run.span(run.lastindex) for run in SPELLED_NEAR.finditer(m.text)]
    out, end = [], 0
    for a, b in sorted(runs):
        if a < end:
            continue
        end, last = b, None
        for word in SPELLED_WORD.finditer(m.text, a, b):
            if last is not None:
                out.append((last, word.start(), "." if WRITTEN_DOT.fullmatch(m.text, last, word.start()) else ""))
            out.append((*word.span(), DIGIT_OF.get(word.group().lower(), "+")))
            last = word.end()
    return out


def brackets(m: Mapped) -> list[tuple[int, int, str]]:
    """(at) and [dot], with the blanks around them."""
    out, end = [], 0
    for found in BRACKETED.finditer(m.text):
        a, b = found.span()
        while a > end and m.text[a - 1] in " \t":
            a -= 1
        while b < len(m.text) and m.text[b] in " \t":
            b += 1
        out.append((a, b, "@" if found.group(1).lower() in ("at", "arroba", "@") else "."))
        end = b
    return out


def told(host: re.Match, m: Mapped | None) -> bool:
    """Whether a host says by itself that it is one, whatever its end: after "arroba", or by a dot in brackets or in words.

    "point" does not count, nor does any word after a determiner: "at some point in", "at this dot matrix".
    """
    a, b = host.span(2)
    if host.group(1).lower() == "arroba":
        return True
    if m is not None and any(m.text[i] == "." and m.end[i] - m.start[i] > 1 for i in range(a, b)):
        return True
    dots = {dot.group().strip().lower() for dot in WRITTEN_DOT.finditer(host.string, a, b)}
    return bool(dots - {"point"}) and re.split(r"[^a-z]", host.group(2).lower(), maxsplit=1)[0] not in DETERMINERS


def hosts(text: str, m: Mapped | None = None) -> Iterator[tuple[int, int, int]]:
    """What follows a name: "at" and a host written out, as the start of "at" and the span of the host. No host begins within another."""
    for name in AT.finditer(text):
        found = ANY_HOST.match(text, name.end())
        if found and told(found, m):
            yield found.start(), *found.span(2)
        elif found := HOST.match(text, name.end()):
            yield found.start(), *found.span(1)


def disguised(text: str) -> bool:
    """Whether some transducer may change the text. Most texts are told by their words, without a look for whole forms."""
    if not text.isascii() and ODD.search(text):
        return True
    words = text.lower().replace("-", " ").split()
    dots = not DOTS.isdisjoint(words)
    return (
        bool(BRACKETED.search(text))
        or (not NAMES_AT.isdisjoint(words) and any(True for _ in hosts(text)))
        or (dots and (bool(NUMBER_DOT.search(text)) or any(WRITTEN_DOT.search(found.group()) for found in AFTER_SIGN.finditer(text))))
        or (not DIGIT_OF.keys().isdisjoint(words) and bool(SPELLED_RUN.search(text) or SPELLED_NEAR.search(text)))
    )


def written_out(m: Mapped) -> list[tuple[int, int, str]]:
    """name at host dot com, name@host dot com, and numbers joined by dot."""
    out = []
    for at, a, b in hosts(m.text, m):
        out.append((at - 1, a, "@"))
        out += [(*dot.span(), ".") for dot in WRITTEN_DOT.finditer(m.text, a, b)]
    for found in AFTER_SIGN.finditer(m.text):
        out += [(*dot.span(), ".") for dot in WRITTEN_DOT.finditer(m.text, *found.span())]
    out += [(*dot.span(), ".") for dot in NUMBER_DOT.finditer(m.text)]
    return sorted(set(out))


def apart(edits: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Without edits that overlap an earlier one."""
    out, end = [], 0
    for edit in edits:
        if edit[0] >= end:
            out.append(edit)
            end = edit[1]
    return out


def find(text: str | None) -> list[tuple[str, int, int, bool]]:
    """All identifiers as (kind, start, end, plain?), by start, then kind. Offsets are code points, ends exclusive.

    Plain matches always stay. A match in the undisguised text is added if its source is not within a plain match of its kind.
    Null and empty text has none.
    """
    text = text or ""
    base = plain(text)
    out = [(*span, True) for span in base]
    if disguised(text):
        where = np.arange(len(text), dtype=np.int64)
        m = Mapped(text, where, where + 1)
        for step in (look_alikes, spelled_digits, brackets, written_out):
            m = m.rewrite(apart(step(m)))
        if m.text != text:
            own: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
            for kind, a, b in base:
                own[kind].append((a, b))
            ends = {k: np.array([b for _, b in spans]) for k, spans in own.items()}
            for kind, a, b in plain(m.text):
                a, b = int(m.start[a]), int(m.end[b - 1])
                # the first plain match that ends at b or later is the only one that could hold this
                at = int(np.searchsorted(ends[kind], b)) if own[kind] else 0
                if not (at < len(own[kind]) and own[kind][at][0] <= a):
                    out.append((kind, a, b, False))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def mask(text: str | None, spans: list[tuple[str, int, int, bool]]) -> str | None:
    """The text with each identifier replaced by its kind in angle brackets; overlapping ones by the first's."""
    if text is None:
        return None
    out, end = [], 0
    for kind, a, b, _ in spans:
        if a >= end:
            out += [text[end:a], f"<{kind}>"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", masked: bool = False) -> DataFrame:
    """``key`` and ``spans``, an array of (kind, start, end, plain), a row per row of ``docs``; with ``masked`` also the masked text.

    Texts are read whole; null and empty ones have no spans. Repeated rows and null keys are kept; other columns are not
    looked at. One scan, no shuffle.
    """

    def run(batches) -> Iterator:
        import pandas as pd

        for batch in batches:
            found = [find(t) for t in batch["text"]]
            out = pd.DataFrame({"key": batch["key"], "spans": [[dict(zip(("kind", "start", "end", "plain"), s)) for s in spans] for spans in found]})
            if masked:
                out["masked"] = [mask(t, s) for t, s in zip(batch["text"], found)]
            yield out

    schema = "key string, spans array<struct<kind: string, start: bigint, end: bigint, plain: boolean>>" + ", masked string" * masked
    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    out = rows.mapInPandas(run, schema)
    return out.withColumn("key", F.col("key").cast(docs.schema[key].dataType)).withColumnRenamed("key", key)
