"""Spelling variants by dynamic programming over sorted word lists.

Two words are near if one inserted, deleted or replaced code point turns one
into the other.  Let ``m`` be the length of the shorter word.  The edit lies in
the first or in the second half of ``m`` places, so near words agree on the
other half: a list holds the words of ``m`` or ``m + 1`` code points that are
equal outside a free range of places.  Each word is in at most four lists.

* A list of more than ``MOST`` words is split: its free range is halved, and
  each of its words goes on into both lists (whose fixed part is longer).  Down
  to one free place, a list holds at most 64 + 64**2 words whatever the corpus,
  so no key, however frequent, makes a list that a task cannot hold.
* A list is sorted and scanned once for each of its words.  The rows of the
  edit matrix, cut to the band of one edit, are kept by depth; the next word
  takes over the rows of the prefix that it shares with the one before (LCP),
  and a range of words whose shared prefix is already more than one edit away is
  passed over.
* A pair belongs to the one list whose free range holds its first difference,
  so no pair is counted twice.  A list gives one row for each of its words (how
  many near words, and the best of them), never its pairs.

A word's form is its near word of largest count, if that is at least ``RATIO``
times the word's own.  Counts grow tenfold along forms, so chains are short and
the last form of each is found by pointer doubling.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, join_counted, staged, table, text_of

#: Words with fewer code points are left out, and words with fewer occurrences.
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A form occurs at least this many times as often as its variant.
RATIO = 10
#: Words in a list that is not split.
MOST = 600
#: One run in so many loses a code point (the contract's typing errors).
NOISE = 31


def runs_of(docs: DataFrame, *, noise: int | None = NOISE, least: int = LEAST_LENGTH, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(word): each maximal run of letters with at least ``least`` code points, A-Z lower-cased.

    With ``noise``, a run whose crc32 of ``<id>:<run>`` is divisible by it
    loses the code point at crc32 % length.
    """
    low = F.translate(text_of(text_col), UPPER, LOWER)
    runs = F.regexp_extract_all(low, F.lit("[a-zÀ-ÿ]{%d,}" % least), F.lit(0))
    words = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    if noise is None:
        return words.select(F.col("run").alias("word"))
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    words = words.select("run", h.alias("h"), (h % F.length("run")).cast("int").alias("at"))
    cut = F.concat(F.substring(F.col("run"), F.lit(1), F.col("at")), F.substring(F.col("run"), F.col("at") + 2, F.length("run")))
    return words.select(F.when(F.col("h") % noise == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= least)


def vocabulary(words: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the distinct words with at least ``least_count`` occurrences."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _key(word: Column, m: Column, lo: Column, hi: Column) -> Column:
    """What is fixed in a list: the first ``lo`` code points and the last ``m - hi``."""
    tail = m - hi
    return F.concat(F.substring(word, F.lit(1), lo), F.lit("\x00"), F.substring(word, F.length(word) - tail + 1, tail))


def _entries(rows: DataFrame, ranges: Column) -> DataFrame:
    """(word, n, m, lo, hi, key) for each of the ``ranges``, structs of (m, lo, hi)."""
    rows = rows.select("word", "n", F.explode(ranges).alias("r")).select("word", "n", "r.*")
    return rows.withColumn("key", _key(F.col("word"), F.col("m"), F.col("lo"), F.col("hi")))


def _range(m: Column, lo: Column, hi: Column) -> Column:
    return F.struct(m.cast("int").alias("m"), lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))


LIST = ["m", "lo", "hi", "key"]


def lists(words: DataFrame, most: int = MOST, least: int = LEAST_LENGTH) -> DataFrame:
    """The words (word, n), entered into all lists that they belong to; no list has both more than ``most`` words and two free places."""
    size = F.length("word")
    halves = lambda m: [_range(m, F.lit(0), F.floor(m / 2)), _range(m, F.floor(m / 2), m)]
    ranges = F.filter(F.array(*halves(size), *halves(size - 1)), lambda r: r["m"] >= least)
    rows = _entries(words, ranges)
    parts = []
    while True:
        hot = staged(rows.groupBy(*LIST).agg(F.count(F.lit(1)).alias("size"))
                     .where((F.col("size") > most) & (F.col("hi") - F.col("lo") > 1)).select(*LIST), "hot-lists")
        if hot.isEmpty():
            return reduce(DataFrame.unionByName, parts, rows)
        same = lambda: reduce(lambda a, b: a & b, [rows[c] == hot[c] for c in LIST])
        parts.append(join_counted(rows, hot, same(), "left_anti"))
        mid = F.floor((F.col("lo") + F.col("hi")) / 2)
        split = F.array(_range(F.col("m"), F.col("lo"), mid), _range(F.col("m"), mid, F.col("hi")))
        rows = staged(_entries(join_counted(rows, hot, same(), "left_semi"), split), "split-lists")


def _next_row(row: tuple[int, int, int], before: bool, here: bool, after: bool) -> tuple[int, int, int]:
    """The banded row of the edit matrix below ``row``; the flags say which of three code points of the query the new one equals.

    A row at depth d holds the distances of d code points to the query's first
    d - 1, d and d + 1; 2 stands for two or more.
    """
    a, b, c = row
    low = min(a + (not before), b + 1)
    mid = min(b + (not here), c + 1, low + 1)
    high = min(c + (not after), mid + 1)
    return min(low, 2), min(mid, 2), min(high, 2)


_ROWS = list(itertools.product(range(3), repeat=3))
#: The row after each row, by the three flags as bits 1, 2 and 4; rows go by their place in _ROWS.
STEP = [[_ROWS.index(_next_row(r, bool(e & 1), bool(e & 2), bool(e & 4))) for e in range(8)] for r in _ROWS]
START, ALIVE = _ROWS.index((2, 0, 1)), [min(r) < 2 for r in _ROWS]


def shared_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def near_pairs(words: list[str]) -> Iterator[tuple[int, int]]:
    """The places (i, j), i < j, of words one edit apart in a sorted list of distinct words."""
    n = len(words)
    lcp = [0] + [shared_prefix(words[j - 1], words[j]) for j in range(1, n)]
    for i in range(n - 1):
        query = words[i]
        size = len(query)
        padded = "\x00" + query + "\x00\x00"
        rows = [START]  # the row at each depth of the word last scanned
        j = i + 1
        while j < n:
            word = words[j]
            del rows[lcp[j] + 1:]
            depth, state, dead = len(rows) - 1, rows[-1], 0
            for depth in range(depth, len(word)):
                ch = word[depth]
                if depth > size:
                    dead = depth
                    break
                state = STEP[state][(ch == padded[depth]) | (ch == padded[depth + 1]) << 1 | (ch == padded[depth + 2]) << 2]
                rows.append(state)
                if not ALIVE[state]:
                    dead = depth + 1
                    break
            else:
                if abs(size - len(word)) <= 1 and _ROWS[state][1 + size - len(word)] == 1:
                    yield i, j
            j += 1
            if dead:
                while j < n and lcp[j] >= dead:
                    j += 1
                if j < n:  # the rows that the passed words share with the next one
                    del rows[lcp[j] + 1:]


def _scan_list(words: list[str], counts: list[int], m: int, lo: int, hi: int) -> Iterator[tuple[str, int, int, str]]:
    """(word, near, best_n, best) for the words of one list that have near words in it."""
    free = [w[lo:len(w) - (m - hi)] for w in words]
    order = sorted(range(len(words)), key=free.__getitem__)
    text = [free[i] for i in order]
    got: dict[int, list] = {}
    for i, j in near_pairs(text):
        a, b = order[i], order[j]
        if len(words[a]) + len(words[b]) > 2 * m + 1:
            continue  # both longer: a pair of the next length
        if hi < m and shared_prefix(text[i], text[j]) >= hi - lo:
            continue  # the first difference lies further on
        for x, y in ((a, b), (b, a)):
            mine = got.setdefault(x, [0, (0, "")])
            mine[0] += 1
            mine[1] = min(mine[1], (-counts[y], words[y])) if mine[1][0] else (-counts[y], words[y])
    for x, (near, best) in got.items():
        yield words[x], near, -best[0], best[1]


def scan_lists(entries: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): of each word with near words how many, and the one of largest count (ties: the smallest)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def scanned(b: pd.DataFrame) -> pd.DataFrame:
            out: list[tuple] = []
            words, counts = b["word"].tolist(), b["n"].tolist()
            m, lo, hi = (b[c].tolist() for c in ("m", "lo", "hi"))
            starts = np.append(_starts(b), len(b))
            for s, e in zip(starts[:-1], starts[1:]):
                if e - s > 1:
                    out.extend(_scan_list(words[s:e], counts[s:e], m[s], lo[s], hi[s]))
            return pd.DataFrame(out, columns=["word", "near", "best_n", "best"])

        for b in batches:
            last = int(_starts(b)[-1]) if len(b) else 0
            if held and len(b):
                same = all(held[-1][c].iloc[-1] == b[c].iloc[0] for c in LIST)
                if last == 0 and same:  # the list goes on; it is bounded, so is what is held
                    held.append(b)
                    continue
            yield scanned(pd.concat([*held, b.iloc[:last]], ignore_index=True))
            held = [b.iloc[last:]]
        if held:
            yield scanned(pd.concat(held, ignore_index=True))

    dealt = entries.repartition(*LIST).sortWithinPartitions(*LIST)
    found = dealt.mapInPandas(run, "word string, near long, best_n long, best string")
    return (found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("b"))
            .select("word", "n_near", (-F.col("b.n")).alias("best_n"), "b.best"))


def _starts(b: pd.DataFrame) -> np.ndarray:
    """The places where a new list begins."""
    new = np.zeros(len(b), dtype=bool)
    new[:1] = True
    for c in LIST:
        v = b[c].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the end of the chain of forms, by pointer doubling."""
    roots = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("at"), F.col("root").alias("ahead"))
        step = staged(roots.join(ahead, F.col("root") == F.col("at"), "left")
                      .select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), "roots")
        roots = step.select("word", "root")
        if step.where("moved").isEmpty():
            return roots


def group_spellings(docs: DataFrame, *, noise: int | None = None, least: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                    ratio: int = RATIO, most: int = MOST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of the texts.

    Words are maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF) with A-Z
    lower-cased, ``least`` code points and ``least_count`` occurrences or more.
    Form is the near word of largest count (ties: the smallest in code-point
    order), if that is at least ``ratio`` times n; root the last word reached
    over forms, the word itself if it has none.

    Null, empty and white texts have no words; a null id counts as an empty one
    where ``noise`` asks for it.  Repeated rows count each time.  An empty table
    gives no rows.  Other columns are ignored, whatever their names.  Words may
    be of any length.
    """
    if least < 2:
        raise ValueError("words of one code point have no half in common")
    words = staged(vocabulary(runs_of(docs, noise=noise, least=least, id_col=id_col, text_col=text_col), least_count), "vocabulary")
    near = scan_lists(lists(words, most, least))
    form = F.col("best_n") >= F.lit(ratio) * F.col("n")
    known = staged(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(form, F.col("best")).alias("form"), F.when(form, F.col("best_n")).alias("form_n")), "near-words")
    roots = last_forms(known.where("form is not null").select("word", "form"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_sorted_list_spellings(spark, sf_dir: str) -> DataFrame:
    """With the contract's typing errors."""
    return group_spellings(table(spark, sf_dir, "documents"), noise=NOISE)
