"""Language-model scoring by prediction by partial matching (PPM) over bytes.

Training counts which byte follows each context of up to ``ORDER`` bytes, over
all training documents.  A symbol is predicted in the longest context known;
one not seen there costs an escape (method C: an escape counts as often as
there are distinct symbols), and the next shorter context predicts it with the
symbols already ruled out excluded.  Below order 0 the bytes never seen are
equally likely.  Byte 0xFF, which UTF-8 never has, begins and ends a text.

The model is fixed after training, so the probability of each symbol in each
context, escapes and exclusions multiplied in, is worked out once, order by
order, by joins of each context with its suffix: a Spark table of (gram, log10
p) for every gram of ``ORDER`` + 1 bytes in any text, seen in training or not.
No context is left out.  Grams with more than ``GRAM_SHARE`` of all symbols (at
most 1 / GRAM_SHARE grams) go to the tasks, the others are joined, counted
within each document first.

The base score is a smoothed unigram model of words.  Its counts grow with the
corpus: counts of words with more than ``WORD_SHARE`` of all tokens (at most
1 / WORD_SHARE words) go to the tasks, the others are joined.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, staged, table, text_of

ORDER = 5
#: Least share of a context in a trie in memory (``build``); the table of all grams has no such bound.
CONTEXT_SHARE = 5e-6
WORD_SHARE = 2e-6
GRAM_SHARE = 2e-7
#: What stands in the word column for a byte gram, and for the row of a document: no word has white space.
GRAM, DOCUMENT = " ", "\t"
MARK = 0xFF
FOLDS = 10
#: Distinct words, and gram counts, that a task gathers before it hands them on, and bytes that are looked up at once.
FLUSH_WORDS, FLUSH_GRAMS, CHUNK_BYTES = 200_000, 1_000_000, 1 << 20
#: Rows handed on at once: a larger frame is held by the task as columns, as Arrow's buffers and as a batch in the JVM.
SEND_ROWS = 100_000
SMOOTH = 0.1


def as_objects(texts: list[str]) -> pd.Series:
    """A column of plain strings: the inferred string type can come in several Arrow chunks, which Spark refuses."""
    return pd.Series(texts, dtype=object)


def marked(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, each after ORDER marks and before one; and where each text (its marks before included) begins."""
    head, tail = bytes([MARK]) * ORDER, bytes([MARK])
    sizes = np.fromiter((len(r) + ORDER + 1 for r in raws), dtype=np.int64, count=len(raws))
    return np.frombuffer(b"".join(x for r in raws for x in (head, r, tail)), dtype=np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def chunks(raws: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in runs of about CHUNK_BYTES, no text divided."""
    part, size = [], 0
    for r in raws:
        part.append(r)
        size += len(r)
        if size >= CHUNK_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def positions(raws: list[bytes]) -> np.ndarray:
    """The codes of ORDER + 1 bytes in a row that end within the texts: one for each byte and each end, in order."""
    data, begins = marked(raws)
    code = np.zeros(max(0, len(data) - ORDER), dtype=np.int64)
    for i in range(ORDER + 1):
        code = code << 8 | data[i:i + len(code)]
    inside = np.ones(len(code), dtype=bool)
    for b in begins[1:-1]:
        inside[b - ORDER:b] = False  # ends among the marks before the next text
    return code[inside]


def grams(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes of ``positions`` and their counts."""
    return np.unique(positions(raws), return_counts=True)


def training_counts(docs: DataFrame, text_col: str, trains: Column) -> DataFrame:
    """(word, code, n, met), written out: counts of words ('' counts the ends) and of byte grams (word is null).

    ``n`` counts the rows where ``trains``; ``met`` those that do not train too, of which only grams are counted.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter = Counter()
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def gram_rows() -> Iterator[pd.DataFrame]:
            codes = np.concatenate([c for c, _, _ in held])
            order = np.argsort(codes, kind="stable")
            codes = codes[order]
            first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            n, met = (np.add.reduceat(np.concatenate([h[k] for h in held])[order], first, dtype=np.int64) for k in (1, 2))
            held.clear()
            codes = codes[first]
            for at in range(0, len(codes), SEND_ROWS):
                part = slice(at, at + SEND_ROWS)
                yield pd.DataFrame({"word": pd.Series([None] * len(codes[part]), dtype=object), "code": codes[part], "n": n[part], "met": met[part]})

        def word_rows() -> pd.DataFrame:
            out = pd.DataFrame({"word": as_objects([w.decode() for w in words]), "code": np.zeros(len(words), dtype=np.int64),
                                "n": np.fromiter(words.values(), dtype=np.int64, count=len(words))})
            out["met"] = out["n"]
            words.clear()
            return out

        for b in batches:
            raws = [t.encode("utf-8", "replace").lower() for t in b["text"]]
            learn, only_met = ([r for r, t in zip(raws, b["trains"]) if t == wanted] for wanted in (True, False))
            for part, trained in ((p, t) for some, t in ((learn, 1), (only_met, 0)) for p in chunks(some)):
                codes, met = grams(part)
                met = met.astype(np.int32)  # a part is a chunk, or one text
                held.append((codes, met * trained, met))
                if sum(len(h[0]) for h in held) > FLUSH_GRAMS:
                    yield from gram_rows()
                if not trained:
                    continue
                for r in part:
                    words.update(r.split())
                words[b""] += len(part)
                if len(words) > FLUSH_WORDS:
                    yield word_rows()
        if words:
            yield word_rows()
        if held:
            yield from gram_rows()

    found = docs.select(text_of(text_col).alias("text"), trains.alias("trains")).mapInPandas(run, "word string, code long, n long, met long")
    return staged(found.groupBy("word", "code").agg(F.sum("n").alias("n"), F.sum("met").alias("met")), "training-counts")


@dataclass(frozen=True)
class Trie:
    """Flattened contexts: row 0 is the empty one, the last row stands for 'none'."""
    symbol: np.ndarray  # (256,) column of each byte; the last column is for bytes never seen
    longer: np.ndarray  # (rows, columns) row of the context with one older byte, or the last row
    log10p: np.ndarray  # (rows, columns)

    def score(self, raws: list[bytes]) -> np.ndarray:
        """log10 probability of each text, its end included."""
        width = self.log10p.shape[1]
        none = len(self.log10p) - 1
        longer, log10p = self.longer.ravel(), self.log10p.ravel()
        out = []
        for part in chunks(raws):
            data, begins = marked(part)
            s = self.symbol[data].astype(np.int32)
            n = len(s) - ORDER
            at = np.zeros(n, dtype=np.int32)
            row = at
            for j in range(ORDER):
                at = longer.take(at * width + s[ORDER - 1 - j:ORDER - 1 - j + n])
                row = np.where(at == none, row, at)
            p = np.concatenate([np.zeros(ORDER), log10p.take(row * width + s[ORDER:])])
            total = np.concatenate([[0.0], np.cumsum(p, dtype=np.float64)])
            out.append(total[begins[1:]] - total[begins[:-1] + ORDER])
        return np.concatenate(out) if out else np.zeros(0)


def build(entries: list[tuple[np.ndarray, np.ndarray]]) -> Trie:
    """The tables in memory, which tests hold against a plain count, from, for each order from 0 up, the codes (context and symbol, in bytes) and their counts."""
    seen = np.unique(entries[0][0] & 0xFF) if len(entries[0][0]) else np.zeros(0, dtype=np.int64)
    width = len(seen) + 1
    symbol = np.full(256, width - 1, dtype=np.int64)
    symbol[seen] = np.arange(len(seen))
    unseen = max(1, 256 - len(seen))
    contexts, tables, first, offset = [], [], [], 0
    counts_below = rest_below = None
    for j, (codes, n) in enumerate(entries):
        own = np.unique(codes >> 8) if j else np.zeros(1, dtype=np.int64)
        counts = np.zeros((len(own), width))
        counts[np.searchsorted(own, codes >> 8), symbol[codes & 0xFF]] = n
        known = counts > 0
        total, kinds = counts.sum(axis=1, keepdims=True), known.sum(axis=1, keepdims=True)
        if j:
            suffix = np.searchsorted(contexts[-1], own & ((1 << 8 * (j - 1)) - 1))
            lower = counts_below[suffix] * ~known  # what the next shorter context has, without the symbols ruled out
            left, new = lower.sum(axis=1, keepdims=True), (lower > 0).sum(axis=1, keepdims=True)
            share = np.divide(new, left + new, out=np.ones_like(left), where=left + new > 0)
            rest = np.where(counts_below[suffix] > 0, lower / np.maximum(left + new, 1), share * rest_below[suffix])
        else:
            rest = np.where(known, 0, 1.0 / unseen)
        escape = np.where(total > 0, kinds / np.maximum(total + kinds, 1), 1.0)
        p = np.where(known, counts / np.maximum(total + kinds, 1), escape * rest)
        tables.append(np.log10(np.maximum(p, 1e-300)))
        contexts.append(own)
        first.append(offset)
        offset += len(own)
        counts_below, rest_below = counts, rest
    longer = np.full((offset + 1, width), offset, dtype=np.int32)
    for j in range(1, len(entries)):
        own = contexts[j]
        shorter = first[j - 1] + np.searchsorted(contexts[j - 1], own & ((1 << 8 * (j - 1)) - 1))
        longer[shorter, symbol[own >> 8 * (j - 1)]] = first[j] + np.arange(len(own))
    log10p = np.concatenate([*tables, np.zeros((1, width))]).astype(np.float32)
    return Trie(symbol, longer, log10p)


def gram_probabilities(counts: DataFrame) -> DataFrame:
    """(code, met, log10p), written out, of every gram in ``counts``; a gram with n = 0 is predicted from its longest known context.

    For each order from 0 up, ``below`` has of each context and symbol (code):
    the symbol's count, the context's total and kinds, and ``rest``, the
    probability of the symbol after an escape from this context.  A code finds
    its suffix there by a join; at most 256 rows share a context.
    """
    codes = counts.where("word is null").select("code", "n", "met")

    def of_order(j: int) -> DataFrame:
        if j == ORDER:
            return codes
        return codes.groupBy(F.col("code").bitwiseAND(F.lit((1 << 8 * (j + 1)) - 1)).alias("code")).agg(F.sum("n").alias("n"))

    total, kinds = of_order(0).agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    rows = of_order(0).select("code", "n", F.lit(total).cast("long").alias("total"), F.lit(kinds).cast("long").alias("kinds"),
                              F.lit(1.0 / max(1, 256 - kinds)).alias("rest"))
    context = Window.partitionBy(F.shiftright("code", 8))
    for j in range(1, ORDER + 1):
        below = rows.select(F.col("code").alias("suffix"), *[F.col(c).alias(f"{c}_below") for c in ("n", "total", "kinds", "rest")])
        known = F.when(F.col("n") > 0, 1)
        rows = (of_order(j).join(below, F.col("code").bitwiseAND(F.lit((1 << 8 * j) - 1)) == F.col("suffix"))
                .withColumns({"total": F.sum("n").over(context), "kinds": F.count(known).over(context),
                              "out": F.coalesce(F.sum(known * F.col("n_below")).over(context), F.lit(0))})
                # What the next shorter context has, without the symbols ruled out.
                .withColumns({"new": F.col("kinds_below") - F.col("kinds"), "all": F.col("total_below") - F.col("out") + F.col("kinds_below") - F.col("kinds")})
                .withColumn("rest", F.when(F.col("n_below") > 0, F.col("n_below") / F.greatest("all", F.lit(1)))
                            .otherwise(F.when(F.col("all") > 0, F.col("new") / F.greatest("all", F.lit(1))).otherwise(1.0) * F.col("rest_below"))))
        rows = rows.select("code", "n", "total", "kinds", "rest", *(["met"] if j == ORDER else []))
    space = F.greatest(F.col("total") + F.col("kinds"), F.lit(1))
    p = F.when(F.col("n") > 0, F.col("n") / space).otherwise(F.when(F.col("total") > 0, F.col("kinds") / space).otherwise(1.0) * F.col("rest"))
    return staged(rows.select("code", "met", F.log10(p).alias("log10p")), "gram-probabilities")


@dataclass(frozen=True)
class Common:
    """Grams that go to the tasks: sorted codes and their log10 probabilities."""
    codes: np.ndarray
    log10p: np.ndarray

    def score(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """log10 probability of each text's grams known here; and text, code and number of the others."""
        sizes = np.fromiter((len(r) + 1 for r in raws), dtype=np.int64, count=len(raws))
        of = np.repeat(np.arange(len(raws)), sizes)
        codes, at = np.unique(positions(raws), return_inverse=True)
        if len(self.codes):
            place = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
            have = self.codes[place] == codes
            part = np.where(have, self.log10p[place], 0.0)
        else:
            have, part = np.zeros(len(codes), dtype=bool), np.zeros(len(codes))
        other = ~have[at]
        pairs, times = np.unique(of[other] * len(codes) + at[other], return_counts=True)
        return np.bincount(of, weights=part[at], minlength=len(raws)), pairs // len(codes), codes[pairs % len(codes)], times


def score_documents(docs: DataFrame, *, folds: int = FOLDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score for every row (ids are integers).

    Models learn from the documents whose crc32(id as text) mod ``folds`` is
    not 0; A-Z are lower-cased.  A null text counts as empty: its tokens are
    one end.  Null ids are not held out.  Repeated rows train as often as they
    occur and get equal scores.  Without training documents all bytes are
    equally likely, and the base has counts of 0 (N = 0, V = 0).  An empty
    table gives no rows.  Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    counts = training_counts(docs, text_col, ~held_out(id_col, folds))
    grams_p = gram_probabilities(counts)
    often = GRAM_SHARE * (grams_p.agg(F.sum("met")).first()[0] or 0)
    sent = grams_p.where(F.col("met") > often).select("code", F.col("log10p").cast("double")).toArrow()
    codes, log10p = (sent[c].to_numpy() for c in ("code", "log10p"))
    order = np.argsort(codes)
    ready = Common(codes[order], log10p[order])
    words = counts.where("word is not null").select("word", "n")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    common = {r["word"].encode(): r["n"] for r in words.where(F.col("n") > WORD_SHARE * total).collect()}
    model = spark.sparkContext.broadcast((ready, common))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready, often = model.value
        log10 = {w: float(np.log10(n + SMOOTH)) for w, n in often.items()}
        get = log10.get
        for b in batches:
            done = 0
            for raws in chunks([t.encode("utf-8", "replace").lower() for t in b["text"]]):
                own = b.iloc[done:done + len(raws)]
                done += len(raws)
                yield from rows_of(own, raws, ready, get)

    def rows_of(own: pd.DataFrame, raws: list[bytes], ready: Common, get) -> Iterator[pd.DataFrame]:
        row, word, times = [], [], []
        parts, known, n_tokens = [], [], []
        for i, r in enumerate(raws):
            found = Counter(r.split())
            found[b""] = 1
            part, have = 0.0, 0
            for w, n in found.items():
                v = get(w)
                if v is None:
                    row.append(i)
                    word.append(w)
                    times.append(n)
                else:
                    part += n * v
                    have += n
            parts.append(part)
            known.append(have)
            n_tokens.append(sum(found.values()))
        ids, gone, hashes = (own[c].to_numpy() for c in ("id", "no_id", "text_hash"))
        score, gram_row, gram, gram_times = ready.score(raws)
        # The row of the document itself goes with a key that no text has, of its own, so that it deals out evenly.
        yield pd.DataFrame({"id": ids, "no_id": gone, "text_hash": hashes, "word": as_objects([DOCUMENT] * len(ids)), "code": hashes, "times": 0,
                            "part": parts, "known": known, "n_tokens": n_tokens, "score": score, "copies": 1})
        row = np.array(row, dtype=np.int64)
        for at, keys, code, n in ((row, [w.decode() for w in word], np.zeros(len(row), dtype=np.int64), np.array(times, dtype=np.int64)),
                                  (gram_row, [GRAM] * len(gram), gram, gram_times)):
            for begin in range(0, len(at), SEND_ROWS):
                part = slice(begin, begin + SEND_ROWS)
                rows = at[part]
                yield pd.DataFrame({"id": ids[rows], "no_id": gone[rows], "text_hash": hashes[rows], "word": as_objects(keys[part]), "code": code[part],
                                    "times": n[part], "part": 0.0, "known": 0, "n_tokens": 0, "score": 0.0, "copies": 0})

    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.col(id_col).isNull().alias("no_id"), F.xxhash64(text_of(text_col)).alias("text_hash"),
                        text_of(text_col).alias("text"))
    rows = texts.mapInPandas(run, "id long, no_id boolean, text_hash long, word string, code long, times long, part double, known long, n_tokens long, "
                                  "score double, copies long")
    rare = words.where(F.col("n") <= WORD_SHARE * total).select("word", F.lit(0).cast("long").alias("code"), "n", F.lit(0.0).alias("log10p")) \
        .unionAll(grams_p.where(F.col("met") <= often).select(F.lit(GRAM).alias("word"), "code", F.lit(0).cast("long").alias("n"), "log10p")) \
        .hint("shuffle_hash")
    met = rows.join(rare, ["word", "code"], "left")
    is_gram = F.col("word") == GRAM
    summed = met.groupBy("id", "no_id", "text_hash").agg(
        F.sum("part").alias("part"), F.sum(F.when(~is_gram, F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + SMOOTH))).alias("rare"),
        F.sum(F.col("known") + F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known"),
        F.max("n_tokens").alias("n_tokens"), F.sum("copies").alias("copies"),
        F.sum(F.when(is_gram, F.col("times") * F.col("log10p")).otherwise(F.col("score"))).alias("score"))
    base = (F.col("part") + F.col("rare")) / F.col("copies") - F.col("n_tokens") * F.log10(F.lit(total + SMOOTH * (distinct + 1)))
    summed = summed.withColumn("id", F.when(~F.col("no_id"), F.col("id")))
    return (summed.withColumn("_again", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
            .select(F.col("id").alias(id_col), held_out("id", folds).alias("held_out"), "n_tokens",
                    (F.col("known") / F.col("copies")).cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
                    base.alias("base_score"), (F.col("score") / F.col("copies")).alias("score")))


def op10_partial_matching_scores(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
