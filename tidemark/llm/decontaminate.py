"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are folded: letters and digits in lower case, one space
for whatever lies between.  An item of m characters may be matched with up to
k = floor(m * ``ERRORS``) edits.  Cut into k + 1 pieces, any such match holds
one piece unchanged, so exact piece hits (one Aho-Corasick pass over each
document) miss no match.  Around each hit, the item is verified by Myers'
bit-parallel edit distance against the stretch of text that it could cover.

The items are the query set: they are taken in blocks of bounded size, each
block's automaton goes to the tasks, and all documents are read against it.
Documents are neither shuffled nor cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import table, text_of

#: Edits allowed for a character of a folded item.
ERRORS = 0.05
#: Folded items shorter than this would match by chance; they only match whole.
LEAST = 40
#: Characters of items in a block: bounds what a task holds of the query set.
BLOCK_CHARS = 4_000_000
_BETWEEN = re.compile(r"[\W_]+")


def fold(text: str) -> str:
    return _BETWEEN.sub(" ", text.lower()).strip()


def fold_with_offsets(text: str) -> tuple[str, list[int]]:
    """The folded text, and for each of its characters the place of the one it comes from."""
    out, at, gap = [], [], False
    for i, c in enumerate(text):
        for d in c.lower():
            if not d.isalnum():
                gap = True
                continue
            if gap and out:
                out.append(" ")
                at.append(i)
            gap = False
            out.append(d)
            at.append(i)
    return "".join(out), at


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces as even as can be, with their places."""
    n, cuts = len(item), k + 1
    ends = [n * i // cuts for i in range(cuts + 1)]
    return [(a, item[a:b]) for a, b in zip(ends, ends[1:])]


def masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def best_match(peq: dict[str, int], m: int, text: str, k: int) -> tuple[int, int] | None:
    """(distance, end) of the best match of a pattern of m characters within ``text``, the earliest on a tie;
    None if every one needs more than k edits.  Myers (1999): a column of the matrix is two bit vectors."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, None
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        if score <= k and (best is None or score < best[0]):
            best = (score, j + 1)
            if not score:
                break
    return best


class Block:
    """The items of a block, ready to be searched for."""

    def __init__(self, items: list[tuple[object, str]], errors: float, least: int):
        import ahocorasick

        self.items, by_piece, by_word = [], {}, {}
        for key, text in items:
            folded = fold(text or "")
            if not folded:
                continue
            if len(folded) < least:
                by_word.setdefault(folded.replace(" ", ""), []).append(key)
                continue
            k = int(len(folded) * errors)
            for at, piece in pieces(folded, k):
                by_piece.setdefault(piece, []).append((len(self.items), at))
            self.items.append((key, folded, k))
        self.automaton = ahocorasick.Automaton()
        for piece, where in by_piece.items():
            self.automaton.add_word(piece, (len(piece), where))
        if by_piece:
            self.automaton.make_automaton()
        self.words = ahocorasick.Automaton() if by_word else None
        for word, keys in by_word.items():
            self.words.add_word(word, (len(word), keys))
        if by_word:
            self.words.make_automaton()
        self.masks: dict[int, dict[str, int]] = {}

    def find(self, text: str) -> list[tuple[object, int, int, int]]:
        """(item, start, end, distance) of the best match of each item that the text holds; places in the text."""
        out = self._as_words(text) if self.words else []
        if not self.items:
            return out
        folded = fold(text)
        stretches: dict[int, list[list[int]]] = {}
        for end, (size, where) in self.automaton.iter(folded):
            for i, at in where:
                _, item, k = self.items[i]
                lo = max(0, end - size + 1 - at - k)
                hi = min(len(folded), end - size + 1 - at + len(item) + k)
                spans = stretches.setdefault(i, [])
                if spans and lo <= spans[-1][1] <= hi:
                    # Clipped at the text's end, a later hit of a repeated piece can begin before the stretch.
                    spans[-1][:] = min(spans[-1][0], lo), hi
                elif not spans or not (spans[-1][0] <= lo and hi <= spans[-1][1]):
                    spans.append([lo, hi])
        places = None
        for i in sorted(stretches):
            key, item, k = self.items[i]
            if i not in self.masks:
                self.masks[i] = masks(item)
            best = None
            for lo, hi in stretches[i]:
                got = best_match(self.masks[i], len(item), folded[lo:hi], k)
                if got and (best is None or got[0] < best[0]):
                    best = (got[0], lo, lo + got[1])
                    if not got[0]:
                        break
            if best is None:
                continue
            distance, lo, end = best
            # The start: match the reversed item against the reversed stretch that ends there.
            back = best_match(masks(item[::-1]), len(item), folded[lo:end][::-1], k)
            start = end - (back[1] if back else end - lo)
            if places is None:
                places = fold_with_offsets(text)[1]
            out.append((key, places[start], places[end - 1] + 1, distance))
        return out

    def _as_words(self, text: str) -> list[tuple[object, int, int, int]]:
        """The first place in the text of each short item that stands as whole words, whatever is between its
        letters: "art" is in "ar t", but not in "the party"."""
        folded, at = fold_with_offsets(text)
        kept = [(c, i) for c, i in zip(folded, at) if c != " "]
        alone = lambda i: not (0 <= i < len(text)) or not text[i].isalnum()
        first: dict[int, tuple[list, int, int]] = {}
        for last, (size, keys) in self.words.iter("".join(c for c, _ in kept)):
            start, end = kept[last - size + 1][1], kept[last][1] + 1
            if alone(start - 1) and alone(end):
                first.setdefault(id(keys), (keys, start, end))
        return [(key, start, end, 0) for keys, start, end in first.values() for key in keys]


def blocks(items: DataFrame, id_col: str, text_col: str, chars: int = BLOCK_CHARS) -> Iterator[list[tuple[object, str]]]:
    """The items in blocks of about ``chars`` characters, fetched one partition at a time."""
    block, size = [], 0
    for r in items.select(F.col(id_col).alias("i"), text_of(text_col).alias("t")).orderBy("i", "t").toLocalIterator():
        block.append((r["i"], r["t"]))
        size += len(r["t"])
        if size >= chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_leaks(docs: DataFrame, items: DataFrame, *, errors: float = ERRORS, least: int = LEAST, id_col: str = "doc_id",
               text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """id, item_id, start, end, distance: one row for each item that a document holds, at its best match.

    start..end are code points of the document, end exclusive.  Folding lets a
    match differ from the item in case, punctuation and spacing at no cost.
    Items shorter than ``least`` once folded match only without edits and as
    whole words; items
    that fold to nothing (null and empty ones too) match nothing.  Null and
    empty texts hold nothing.  Null ids stay as they are.  Repeated documents
    get rows each; items repeated as whole rows are searched for once each.
    Empty tables give no rows.  Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema[item_id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).cast("string").alias("_id"), text_of(text_col).alias("_text"))
    out = None
    for block in blocks(items.distinct(), item_id_col, item_text_col):
        sent = spark.sparkContext.broadcast([(None if i is None else str(i), t) for i, t in block])

        def run(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            ready = Block(sent.value, errors, least)
            for b in batches:
                rows = [(d, *hit) for d, t in zip(b["_id"], b["_text"]) for hit in ready.find(t)]
                yield pd.DataFrame(rows, columns=["_id", "_item", "start", "end", "distance"])

        part = texts.mapInPandas(run, "_id string, _item string, start long, `end` long, distance int")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], "_id string, _item string, start long, `end` long, distance int")
    return out.select(F.col("_id").cast(kind).alias(id_col), F.col("_item").cast(item_kind).alias("item_id"),
                      "start", "end", "distance")


def without_leaks(docs: DataFrame, items: DataFrame, *, errors: float = ERRORS, least: int = LEAST, text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold an item, judged as in ``find_leaks``; all columns as they are."""
    def clean(sent):
        def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            ready = Block(sent.value, errors, least)
            for texts in batches:
                yield pd.Series([not ready.find(t) for t in texts], dtype=bool)

        return F.pandas_udf(judge, T.BooleanType())

    out = docs
    for block in blocks(items.distinct(), item_id_col, item_text_col):
        sent = docs.sparkSession.sparkContext.broadcast([(None if i is None else str(i), t) for i, t in block])
        out = out.where(clean(sent)(text_of(text_col)))
    return out


def op5_pigeonhole_leaks(spark, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
