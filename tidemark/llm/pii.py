"""Personal data behind disguises: offset-preserving transducers, detection, and the way back to the source.

A tape is a text whose every code point knows the span of the source that it
stands for, and whether it was rewritten.  Transducers read a tape and write
another:

1. ``fold_glyphs``: look-alikes of ASCII characters become them (compatibility
   forms by Unicode's own rule, Cyrillic and Greek letters by a table, digits of
   other scripts by their value); characters without width are dropped;
2. ``spell_digits``: digit words in a row ("four one double one") become digits,
   and so do letters that stand for digits among them ("4O4l");
3. ``undo_at_dot``: "(at)", " at ", "[dot]", " dot ", "&#64;" and their like
   become "@" and ".".

The identifiers are then found on the last tape by the same detectors as on the
text itself, and each span maps back: its first code point's start in the
source to its last one's end.  A span counts as an added one if it holds a
rewritten code point; those found in the plain text stay as they are.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table, text_of

# The kinds, in this order.
KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping, from each "@" outwards, so that long runs without one cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > done and text[start - 1] in _LOCAL_SET:
                start -= 1
            if start < at:
                yield start, domain.end()
                done = domain.end()
        at = text.find("@", at + 1)


def find(text: str) -> list[Span]:
    """(kind, start, end) of the four kinds, ordered by start and then as listed; leftmost non-overlapping per kind."""
    got = [(s, 0, e) for s, e in _emails(text)]
    got += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _only_digits(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                got.append((m.start(), 2, m.end()))
    if "+" in text:
        got += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_only_digits(m[0])) <= 15]
    return [(KINDS[k], s, e) for s, k, e in sorted(got)]


@dataclass(frozen=True)
class Tape:
    """A text, and for each code point the source's span and whether it was rewritten."""
    text: str
    starts: np.ndarray
    ends: np.ndarray
    rewritten: np.ndarray

    @staticmethod
    def of(text: str) -> Tape:
        at = np.arange(len(text) + 1)
        return Tape(text, at[:-1], at[1:], np.zeros(len(text), dtype=bool))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Tape:
        """The tape with the spans (start, end) replaced by a text each; edits are in order and do not overlap.

        A replacement's code points all stand for the whole span; one that is
        empty widens the code point before it by nothing: the source between
        belongs to whatever span encloses it.
        """
        if not edits:
            return self
        text, keep = [], []
        starts, ends, flags = [], [], []
        done = 0
        for s, e, new in edits:
            text += [self.text[done:s], new]
            for column, out in ((self.starts, starts), (self.ends, ends), (self.rewritten, flags)):
                out.append(column[done:s])
            starts.append(np.full(len(new), self.starts[s]))
            ends.append(np.full(len(new), self.ends[e - 1]))
            flags.append(np.ones(len(new), dtype=bool))
            done = e
        text.append(self.text[done:])
        for column, out in ((self.starts, starts), (self.ends, ends), (self.rewritten, flags)):
            out.append(column[done:])
        flat = np.concatenate(flags)
        out = Tape("".join(text), np.concatenate(starts), np.concatenate(ends), flat)
        # What was dropped inside a span marks it too: the code point before a gap counts as rewritten.
        gap = np.flatnonzero(out.starts[1:] > out.ends[:-1])
        if len(gap):
            flat[gap] = True
        return out


# Letters of other scripts that look like ASCII letters.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ғ": "f", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m",
    "п": "n", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S",
    "Т": "T", "Х": "X", "У": "Y", "З": "3",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "γ": "y", "ω": "w",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T",
    "Υ": "Y", "Χ": "X",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ʟ": "l", "ѡ": "w", "օ": "o", "ո": "n", "ս": "u", "հ": "h",
    "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u2212": "-", "\u00a0": " ", "\u3002": ".", "\u2219": ".",
}
NO_WIDTH = "\u00ad\u034f\u180e\u200b\u200c\u200d\u200e\u200f\u2060\u2061\u2062\u2063\u2064\ufeff"


class _Glyphs(dict):
    """What each code point folds to, for ``str.translate``-like look-ups; worked out when first met."""

    def __missing__(self, c: str) -> str:
        if c in NO_WIDTH:
            new = ""
        elif c in LOOKALIKES:
            new = LOOKALIKES[c]
        elif unicodedata.decimal(c, None) is not None:
            new = str(unicodedata.decimal(c))
        else:
            new = unicodedata.normalize("NFKC", c)
            new = new if len(new) == 1 and " " <= new <= "~" else c
        self[c] = new
        return new


_GLYPHS = _Glyphs()
#: Latin letters with accents are no disguise; beyond them anything may be.
_FOREIGN = re.compile("[\u00a0\u00ad\u0131\u0250-\U0010ffff]")


def fold_glyphs(tape: Tape) -> Tape:
    edits = []
    for m in _FOREIGN.finditer(tape.text):
        new = _GLYPHS[m[0]]
        if new != m[0]:
            edits.append((m.start(), m.end(), new))
    return tape.rewrite(edits)


# The digits in English, French, German and Spanish.
DIGIT_WORDS = {w: str(d) for d, words in enumerate((
    "zero oh nought zéro null cero", "one un une eins ein uno una", "two deux zwei zwo dos", "three trois drei tres",
    "four quatre vier cuatro", "five cinq fünf fuenf cinco", "six sechs seis", "seven sept sieben siete", "eight huit acht ocho",
    "nine neuf neun nueve")) for w in words.split()}
TIMES = {"double": 2, "triple": 3, "treble": 3}
_WORD = r"(?:(?:double|triple|treble)[ \t]+)?(?:" + "|".join(sorted(DIGIT_WORDS, key=len, reverse=True)) + ")"
_BETWEEN = r"(?:[ \t\r\n]*[-,.][ \t\r\n]*|[ \t\r\n]+|[ \t]+(?:dot|point|punto|punkt|dash|hyphen)[ \t]+|)"
_ITEM = rf"(?:(?<!\w){_WORD}(?!\w)|(?<![A-Za-z0-9])[0-9]+(?![A-Za-z0-9]))"
_SPELLED = re.compile(rf"(?:(?<!\w)plus[ \t]+)?{_ITEM}(?:{_BETWEEN}{_ITEM}){{2,}}", re.I)
_TOKEN, _DIGIT = re.compile(r"\w+"), re.compile("[0-9]")
_PIECE = re.compile(rf"(?P<plus>plus[ \t]+)|(?P<word>(?<!\w){_WORD}(?!\w))|(?P<dot>[ \t]+(?:dot|point|punto|punkt)[ \t]+|[ \t\r\n]*\.[ \t\r\n]*)"
                    r"|(?P<dash>[ \t]+(?:dash|hyphen)[ \t]+|[ \t\r\n]*-[ \t\r\n]*)|(?P<gap>[ \t\r\n]*,[ \t\r\n]*|[ \t\r\n]+)", re.I)
#: A row of digits with letters that stand for some of them.
_MIXED = re.compile(r"(?<![A-Za-z0-9])\+?[0-9OolI](?:[ .()-]{0,2}[0-9OolI]){6,}(?![A-Za-z0-9])")
_AS_DIGIT = {"O": "0", "o": "0", "l": "1", "I": "1"}


def _digit_words(text: str) -> list[int]:
    """The places of the digit words among the words of a text."""
    return [i for i, w in enumerate(_TOKEN.findall(text.lower())) if w in DIGIT_WORDS]


def _value(word: str) -> str:
    parts = word.lower().split()
    return DIGIT_WORDS[parts[-1]] * (TIMES[parts[0]] if len(parts) > 1 else 1)


def spell_digits(tape: Tape) -> Tape:
    """Rows of three or more items, two of them digit words or more, become digits, single spaces, dots and hyphens; with dots, no spaces."""
    edits = []
    places = _digit_words(tape.text)
    if any(b - a <= 3 for a, b in zip(places, places[1:])) or len(places) > 1 and _DIGIT.search(tape.text):
        for m in _SPELLED.finditer(tape.text):
            if len(_digit_words(m[0])) < 2:
                continue
            pieces = list(_PIECE.finditer(tape.text, m.start(), m.end()))
            gap = "" if any(p.lastgroup == "dot" for p in pieces) else " "  # between dots, the digits make one number
            for p in pieces:
                new = _value(p[0]) if p.lastgroup == "word" else {"plus": "+", "dot": ".", "dash": "-", "gap": gap}[p.lastgroup]
                if new != p[0]:
                    edits.append((p.start(), p.end(), new))
    tape = tape.rewrite(edits)
    edits = []
    for m in _MIXED.finditer(tape.text) if _DIGIT.search(tape.text) else ():
        letters = sum(c in _AS_DIGIT for c in m[0])
        if letters and 2 * letters <= len(_only_digits(m[0])):
            edits += [(m.start() + i, m.start() + i + 1, _AS_DIGIT[c]) for i, c in enumerate(m[0]) if c in _AS_DIGIT]
    return tape.rewrite(edits)


_AT_WORD, _DOT_WORD = "at|arroba|arobase|ät", "dot|punto|point|punkt"
_OPEN, _CLOSE = r"(?:[ \t]*[\[({<*_|/][ \t]*|[ \t]+-)", r"(?:[ \t]*[\])}>*_|/][ \t]*|-[ \t]+)"
#: Without any of these there is nothing to undo; each begins with a set of characters, which is quick to search for.
_MAY_BE = [re.compile(p, re.I) for p in (
    "[@&]|%(?:40|2e)", rf"[\[({{<*_|/-][ \t]*(?:{_AT_WORD}|{_DOT_WORD}|\.)[ \t]*[\])}}>*_|/-]", rf"[ \t](?:{_DOT_WORD})[ \t]+[A-Za-z0-9]",
    rf"[ \t](?:{_AT_WORD})[ \t]+[A-Za-z0-9-]+\.[A-Za-z0-9]")]
_DISGUISE = re.compile(
    rf"(?P<dot>{_OPEN}(?:{_DOT_WORD}|\.){_CLOSE}|(?<=[A-Za-z0-9-])[ \t]+(?:{_DOT_WORD})[ \t]+(?=[A-Za-z0-9])|&\#0*46;|&period;|%2e"
    rf"|(?<=[A-Za-z0-9-])(?:[ \t]+\.[ \t]*)(?=[a-z]{{2,24}}(?![A-Za-z0-9]))|(?<=[A-Za-z0-9-])\.[ \t]+(?=com(?![A-Za-z0-9])))"
    rf"|(?P<at>{_OPEN}(?:{_AT_WORD}|@){_CLOSE}|(?<=[A-Za-z0-9._%+-])[ \t]+@[ \t]*|@[ \t]+(?=[A-Za-z0-9])|&\#0*64;|&commat;|%40)"
    rf"|(?P<word>(?<=[A-Za-z0-9._%+-])[ \t]+(?:{_AT_WORD})[ \t]+(?=[A-Za-z0-9]))", re.I)
# Words before a plain "at" that are no mailbox.
NO_MAILBOX = frozenset("""a am an and any are available be been book buy call chat click download find found get go hosted here him her his
    i in is it join live located look looked looking me meet more not now of on one online only or page posted read register see seen sign
    site start stay still stop that the them there these they this to today us visit was website well were work working you your""".split())


def undo_at_dot(tape: Tape) -> Tape:
    edits, text = [], tape.text
    if any(p.search(text) for p in _MAY_BE):
        for m in _DISGUISE.finditer(text):
            if m.lastgroup == "word":
                before = _LOCAL.search(text, max(0, m.start() - 64), m.start())
                if before and before[0].lower() in NO_MAILBOX:
                    continue
            edits.append((m.start(), m.end(), "." if m.lastgroup == "dot" else "@"))
    return tape.rewrite(edits)


TRANSDUCERS: tuple[Callable[[Tape], Tape], ...] = (fold_glyphs, spell_digits, undo_at_dot)


def added(text: str, base: list[Span], transducers: tuple[Callable[[Tape], Tape], ...] = TRANSDUCERS) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the identifiers that only the normalised text shows, in source offsets.

    Each transducer's tape is searched, the last one's finds going first: a
    find that overlaps a longer one of its kind, found earlier, is left out.
    """
    tapes, tape = [], Tape.of(text)
    for t in transducers:
        nxt = t(tape)
        if nxt is not tape:
            tapes.append(nxt)
        tape = nxt
    out: list[tuple[str, int, int, str]] = []
    for tape in reversed(tapes):
        for kind, s, e in find(tape.text):
            if not tape.rewritten[s:e].any():
                continue
            value = tape.text[s:e]
            if kind == "email" and not re.search(r"\.[A-Za-z]{2,24}\Z", value):
                continue  # what is put together has to end like a domain
            start, end = int(tape.starts[s]), int(tape.ends[e - 1])
            if (kind, start, end) not in base and not any(k == kind and a < end and start < b for k, a, b, _ in out):
                out.append((kind, start, end, value))
    return out


SPANS = "array<struct<kind:string,start:int,end:int,value:string,base:boolean>>"


def find_personal_data(docs: DataFrame, *, id_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The ``id_cols`` and spans of each row: kind, start, end (code points, end exclusive), value, base.

    Spans are ordered by start, then by kind as listed in KINDS, base ones
    first; value is the identifier as detected, without its disguise.  A null
    text counts as empty; null ids stay as they are; repeated rows get equal
    spans; an empty table gives no rows.  Other columns are ignored, whatever
    their names.
    """
    rows = docs.select(F.struct(*[F.col(c) for c in id_cols]).alias("key"), text_of(text_col).alias("text"))
    key = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for text in b["text"]:
                base = find(text)
                spans = [(s, KINDS.index(k), 0, e, text[s:e]) for k, s, e in base]
                spans += [(s, KINDS.index(k), 1, e, v) for k, s, e, v in added(text, base)]
                out.append([{"kind": KINDS[k], "start": s, "end": e, "value": v, "base": not new} for s, k, new, e, v in sorted(spans)])
            yield pd.DataFrame({"key": b["key"], "spans": out})

    # Ids travel as they are, inside one struct, so that none of their names can clash.
    return rows.mapInPandas(run, f"key {key}, spans {SPANS}").select("key.*", "spans")


def op12_offset_preserving_pii(spark, sf_dir: str) -> DataFrame:
    """n_* count the base spans; spans holds the added ones too, under the same kinds."""
    found = find_personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
