"""Toxicity: a support vector machine on a gap-weighted subsequence kernel with Nyström landmarks.

The kernel of two strings counts their common subsequences of ``ORDER``
symbols, each occurrence weighted by ``DECAY`` to the length that it spans, up
to ``SPAN``.  A span longer than the subsequence is a gap, so a letter put
into an insult, or left out of it, keeps most of its features.  Texts become
symbols: letters, one symbol for white space (so that a word's edges count),
nothing for other characters; letters that stand alone ("i d i o t") are
joined.

Landmarks are short strings of the training sample: those that tell toxic from
clean documents best, and others drawn at random.  An instance is a window of
a sentence; a labelled sentence is judged by its highest window, which the
training finds in rounds (multiple-instance learning).  The machine is linear
in the Nyström features K_mm^(-1/2) k(x, landmarks), hence
f(x) = sum_l beta_l K(x, l): a weight for each subsequence of a landmark, a few
thousand in all, is sum_l beta_l phi(l).  They travel as sorted codes with
weights; a worker spreads them once over a table of all ``ALPHABET ** ORDER``
subsequences (21 MB, whatever the corpus), and scores a text by adding up table
entries along it, vectorised.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import held_out, staged, table, text_of, training_sample

ORDER, SPAN, DECAY, ALPHABET = 4, 7, 0.6, 48  # a letter between every two of four makes a span of seven
#: Subsequences of a window start at as many symbols in a row; most symbols in a landmark.
STARTS, LANDMARK = 4, 6
#: Most labelled rows (about) to fit on; landmarks chosen by class and at random.
SAMPLE_ROWS, CHOSEN, RANDOM = 12_000, 256, 64
#: Landmarks come from the best runs; the kernel of two of them is less than ALIKE.
CANDIDATES, ALIKE = 2500, 0.8
#: Share of the sampled toxic documents in which a run must lie to be considered.
COMMON_SHARE = 0.004
THRESHOLD = 0.5
SPACE, BREAK = 27, 0
OFFSETS = [(0, *rest) for rest in itertools.combinations(range(1, SPAN), ORDER - 1)]
GAIN = [DECAY ** (o[-1] + 1) for o in OFFSETS]
_PAUSE = 254  # while reading: a full stop, an end if white space follows


def _symbol_table() -> np.ndarray:
    """Symbol of each code point below 0x250; 255: none.

    Plain letters fold their case.  Other Latin letters share the 20 symbols above
    the white space by code point, so that accents still tell words apart.
    """
    out = np.full(0x250, 255, dtype=np.uint8)
    for cp in range(0x250):
        c = chr(cp)
        if c.isspace():
            out[cp] = SPACE
        elif c.isalpha():
            low = c.lower()[0]
            out[cp] = ord(low) - 96 if "a" <= low <= "z" else SPACE + 1 + ord(low) % 20
    out[ord("\n")] = BREAK
    out[[ord(c) for c in ".!?"]] = _PAUSE
    return out


SYMBOLS = _symbol_table()


def symbols(text: str) -> np.ndarray:
    """The symbols of a text; sentences are set apart by BREAK, in which no subsequence lies."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    s = SYMBOLS[np.minimum(points, 0x24F)]
    high = points >= 0x250  # other scripts
    if high.any():
        s[high] = (SPACE + 1 + points[high] % 20).astype(np.uint8)
    if not len(s):
        return s
    after = np.append(s[1:], BREAK)
    s[(s == _PAUSE) & ((after == SPACE) | (after == BREAK))] = BREAK
    s = s[s < _PAUSE]
    s = np.concatenate([[SPACE], s, [SPACE]]).astype(np.uint8)  # a text's ends are words' edges
    gap = (s == SPACE) | (s == BREAK)
    s = s[~(gap & np.append(False, gap[:-1]) & (s == SPACE))]  # white space in a row counts once
    gap = np.concatenate([[True], (s == SPACE) | (s == BREAK), [True]])
    single = gap[:-2] & ~gap[1:-1] & gap[2:]  # a letter that stands alone
    apart = (s == SPACE) & np.append(False, single[:-1]) & np.append(single[1:], False)
    return s[~apart]


def _codes(s: np.ndarray, offsets: tuple[int, ...]) -> np.ndarray:
    n = len(s) - offsets[-1]
    code = np.zeros(n, dtype=np.int32)
    for o in offsets:
        code = code * ALPHABET + s[o:o + n]
    return code


def along(s: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each start, the table weight of the subsequences that start there, decayed."""
    n = len(s)
    pad = np.concatenate([s, np.zeros(SPAN, dtype=np.uint8)]).astype(np.int32)
    scaled = [pad * np.int32(ALPHABET ** (ORDER - 1 - k)) for k in range(ORDER)]
    out = np.zeros(n, dtype=np.float32)
    for offsets, gain in zip(OFFSETS, GAIN):
        code = scaled[0][:n] + scaled[1][offsets[1]:offsets[1] + n]
        for part, o in zip(scaled[2:], offsets[2:]):
            code += part[o:o + n]
        out += weights.take(code) * np.float32(gain)
    return out


def with_letter(s: np.ndarray, at: int) -> np.ndarray:
    """The symbols with a letter put in shortly after ``at``; which and where follows from ``at``."""
    return np.insert(s, min(at + 2 + at % 3, len(s)), 1 + (at * 7 + 3) % 26)


def windows(s: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """f of the window at each symbol: of the subsequences that start at it or at the STARTS - 1 symbols after."""
    if not len(s):
        return np.zeros(0)
    c = np.concatenate([[0.0], np.cumsum(along(s, weights))])
    return c[np.minimum(np.arange(len(s)) + STARTS, len(s))] - c[:-1]


def phi(s: np.ndarray, starts: int | None = None) -> dict[int, float]:
    """The explicit kernel features of a short string, or of those that start at its first symbols."""
    out: dict[int, float] = {}
    for offsets, gain in zip(OFFSETS, GAIN):
        if len(s) > offsets[-1]:
            for c in _codes(s.astype(np.int32), offsets)[:starts].tolist():
                out[c] = out.get(c, 0.0) + gain
    return {c: v for c, v in out.items() if all((c // ALPHABET**k) % ALPHABET for k in range(ORDER))}


def _matrix(strings: list[np.ndarray]) -> np.ndarray:
    """Rows of normalised features, dense over the codes that occur, with their codes."""
    rows = [phi(s) for s in strings]
    codes = np.unique(np.fromiter((c for r in rows for c in r), dtype=np.int64))
    out = np.zeros((len(rows), len(codes)), dtype=np.float32)
    for i, r in enumerate(rows):
        if r:
            out[i, np.searchsorted(codes, list(r))] = list(r.values())
    norm = np.sqrt((out**2).sum(axis=1, keepdims=True))
    return codes, out / np.where(norm > 0, norm, 1)


@functools.lru_cache(maxsize=2)
def _table(codes: bytes, weights: bytes) -> np.ndarray:
    out = np.zeros(ALPHABET**ORDER, dtype=np.float32)
    out[np.frombuffer(codes, dtype=np.int64)] = np.frombuffer(weights, dtype=np.float32)
    return out


@dataclass(frozen=True)
class Machine:
    """Sorted subsequence codes with their weights, and the map from decisions to probabilities."""
    codes: np.ndarray
    weights: np.ndarray
    slope: float
    offset: float

    @property
    def table(self) -> np.ndarray:
        """The weights of all subsequences, kept by the process for the machine in use."""
        return _table(self.codes.astype(np.int64).tobytes(), self.weights.astype(np.float32).tobytes())

    def decision(self, text: str) -> float:
        s = symbols(text)
        f = windows(s, self.table)
        return float(f.max()) if len(f) else 0.0

    def probability(self, f: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * f + self.offset, -30, 30)))


def _linear_svm(z: np.ndarray, y: np.ndarray, c: float = 10.0, steps: int = 300, rows: int = 2048) -> tuple[np.ndarray, float]:
    """Squared-hinge linear machine with balanced classes, by Newton steps on the active rows.

    ``z`` is read ``rows`` at a time, so that a step needs no copy of it.
    """
    sign = np.where(y > 0, 1.0, -1.0)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())) * len(y) * c
    w = np.zeros(z.shape[1] + 1)
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    active = None
    for step in range(steps):
        now = np.concatenate([sign[at:at + rows] * (z[at:at + rows] @ w[:-1] + w[-1]) < 1 for at in range(0, len(z), rows)])
        if active is not None and (now == active).all():
            break
        active = now
        left, right = ridge.copy(), np.zeros(len(w))
        for at in range(0, len(z), rows):
            on = active[at:at + rows]
            a = np.hstack([z[at:at + rows][on], np.ones((int(on.sum()), 1))]).astype(float)
            aw = a * weight[at:at + rows][on][:, None]
            left += aw.T @ a
            right += aw.T @ sign[at:at + rows][on]
        full = np.linalg.solve(left, right)
        w = 0.5 * w + 0.5 * full if step > 20 else full
    return w[:-1], float(w[-1])


def _prior(bad: int, good: int) -> Machine:
    """The machine that gives every text the share of toxic documents."""
    p = (bad + 0.5) / (bad + good + 1.0)
    return Machine(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.float32), 0.0, float(np.log(p / (1 - p))))


def _platt(f: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic map of decisions to probabilities."""
    scale = max(float(np.abs(f).max()), 1e-9)
    x = np.stack([f / scale, np.ones(len(f))], axis=1)
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (target - p) - 1e-4 * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-7:
            break
    return float(w[0] / scale), float(w[1])


def _runs(text: str) -> np.ndarray:
    """The distinct runs of ORDER..LANDMARK symbols of a text that lie within a word, edges included."""
    s = symbols(text).astype(np.int64)
    got = [np.zeros(0, dtype=np.int64)]
    for n in range(ORDER, LANDMARK + 1):
        if len(s) >= n:
            code = np.zeros(len(s) - n + 1, dtype=np.int64)
            inside = np.ones(len(code), dtype=bool)
            for o in range(n):
                part = s[o:o + len(code)]
                code = code * ALPHABET + part
                inside &= part != BREAK
                if 0 < o < n - 1:
                    inside &= part != SPACE
            got.append(code[inside])
    return np.unique(np.concatenate(got))


def _run_counts(sample: DataFrame, among: np.ndarray | None = None) -> DataFrame:
    """(gram, n): in how many documents of the sample each run lies, counted per batch, then summed."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            runs = [_runs(t) for t in b["_text"]]
            if among is not None:
                runs = [r[np.isin(r, among, assume_unique=True)] for r in runs]
            codes, n = np.unique(np.concatenate(runs or [np.zeros(0, dtype=np.int64)]), return_counts=True)
            yield pd.DataFrame({"gram": codes, "n": n})

    return sample.select("_text").mapInPandas(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _string(code: int) -> np.ndarray:
    out = []
    while code:
        out.append(code % ALPHABET)
        code //= ALPHABET
    return np.array(out[::-1], dtype=np.uint8)


def association(n_bad: np.ndarray, n_good: np.ndarray, bad: int, good: int) -> np.ndarray:
    """Log-likelihood ratio of each run with the toxic class; 0 for runs that are no commoner there."""
    p, q, both = n_bad / bad, n_good / good, (n_bad + n_good) / (bad + good)

    def bits(n: np.ndarray, of: int, rate: np.ndarray) -> np.ndarray:
        rate = np.clip(rate, 1e-12, 1 - 1e-12)
        return n * np.log(rate) + (of - n) * np.log(1 - rate)

    return np.where(p > q, 2 * (bits(n_bad, bad, p) + bits(n_good, good, q) - bits(n_bad, bad, both) - bits(n_good, good, both)), 0)


def _unlike(ranked: list[tuple[int, float]]) -> list[tuple[int, float]]:
    """The best landmarks, each unlike those before it, so that every insult gets some."""
    if not ranked:
        return []
    _, feats = _matrix([_string(g) for g, _ in ranked])
    nearest, out = np.zeros(len(ranked)), []
    for i, item in enumerate(ranked):
        if nearest[i] < ALIKE:
            out.append(item)
            nearest = np.maximum(nearest, feats @ feats[i])
            if len(out) == CHOSEN:
                break
    return out


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", rows: int = SAMPLE_ROWS, folds: int = 5,
                 rounds: int = 3, id_col: str = "doc_id", text_col: str = "text") -> Machine:
    """Fit on a bounded sample of labelled documents outside the held-out fold."""
    sample = staged(training_sample(docs, labels, label, rows=rows, folds=folds, id_col=id_col, text_col=text_col)
                    .select(F.col("_id").cast("string").alias("_id"), "_text", "_label"), "toxic-sample")
    sizes = {r["_label"]: r["n"] for r in sample.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return _prior(bad, good)
    # Runs in enough toxic documents: at most (runs a document) / COMMON_SHARE of them.
    common = _run_counts(sample.where("_label = 1")).where(F.col("n") >= max(2, int(COMMON_SHARE * bad))).toPandas()
    codes_bad, n_bad = common["gram"].to_numpy(), common["n"].to_numpy(dtype=float)
    order = np.argsort(codes_bad)
    codes_bad, n_bad = codes_bad[order], n_bad[order]
    clean = _run_counts(sample.where("_label = 0"), codes_bad).toPandas()
    n_good = np.zeros(len(codes_bad))
    n_good[np.searchsorted(codes_bad, clean["gram"].to_numpy())] = clean["n"].to_numpy()
    z = association(n_bad, n_good, bad, good)
    best = _unlike([(int(codes_bad[i]), float(z[i])) for i in np.argsort(-z, kind="stable")[:CANDIDATES] if z[i] > 10])
    spread = np.random.default_rng(7).permutation(len(codes_bad))[:RANDOM]
    marks = list(dict.fromkeys([g for g, _ in best] + [int(codes_bad[i]) for i in np.sort(spread)]))
    if not best:
        return _prior(bad, good)
    strings = [_string(g) for g in marks]
    codes, feats = _matrix(strings)
    values, vectors = np.linalg.eigh(feats @ feats.T)
    root = vectors @ np.diag(np.where(values > 1e-8, 1 / np.sqrt(np.maximum(values, 1e-8)), 0)) @ vectors.T  # K_mm^(-1/2)

    def machine(beta: np.ndarray, slope: float = 1.0, offset: float = 0.0) -> Machine:
        return Machine(codes, (beta @ feats).astype(np.float32), slope, offset)

    def kernels(piece: np.ndarray) -> np.ndarray:
        """The normalised kernel of each landmark with the subsequences that start at a piece's first symbols."""
        met = phi(piece, STARTS)
        at = np.searchsorted(codes, np.fromiter(met, dtype=np.int64, count=len(met)))
        x = np.zeros(len(codes) + 1)
        known = codes[np.minimum(at, len(codes) - 1)] == np.fromiter(met, dtype=np.int64, count=len(met))
        x[at[known]] = np.fromiter(met.values(), dtype=float, count=len(met))[known]
        return feats @ x[:-1]

    weight = dict(best)
    current = machine(np.array([weight.get(g, 0.0) for g in marks]) / max(1.0, sum(weight.values())))
    for turn in range(rounds):
        now = current

        def witness(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                out = []
                for key, text, y in zip(b["_id"], b["_text"], b["_label"]):
                    s = symbols(text)
                    f = windows(s, now.table)
                    picks = {int(f.argmax())} if len(f) else set()
                    if len(f) and not y:  # a clean document's other windows are clean as well
                        half = len(f) // 2
                        picks |= {half, half + int(f[half:].argmax())}
                    for i in picks:
                        pieces = [s] + ([with_letter(s, i)] if y else [])  # the same insult with a letter put in
                        for piece in pieces:
                            k = kernels(piece[i:i + STARTS + SPAN - 1])
                            out.append((key, int(y), i, float(f[i]), k.astype(np.float32).tobytes()))
                yield pd.DataFrame(out, columns=["id", "y", "at", "f", "k"])

        got = sample.mapInPandas(witness, "id string, y int, at int, f double, k binary").toPandas()
        if turn:  # labels err: a toxic document whose best window lies among the clean ones has none to learn from
            clean = got["f"][got["y"] == 0]
            got = got[(got["y"] == 0) | (got["f"] > clean.quantile(0.9))]
        got = got.sort_values(["id", "at", "k"], kind="stable")
        y = got["y"].to_numpy()
        z = np.empty((len(got), len(marks)), dtype=np.float32)  # the sample's bound times 1.3 KB, the driver's largest array
        for i, k in enumerate(got.pop("k")):
            z[i] = np.frombuffer(k, dtype=np.float32) @ root
        del got
        w, _ = _linear_svm(z, y)
        del z
        current = machine(root @ w)

    last = current

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for text, y in zip(b["_text"], b["_label"]):
                s = symbols(text)
                f = windows(s, last.table)
                out.append((int(y), float(f.max()) if len(f) else 0.0))
                if y and len(f):
                    out.append((1, float(windows(with_letter(s, int(f.argmax())), last.table).max())))
            yield pd.DataFrame(out, columns=["y", "f"])

    got = sample.mapInPandas(judge, "y int, f double").toPandas().sort_values(["f", "y"], kind="stable")
    slope, offset = _platt(got["f"].to_numpy(), got["y"].to_numpy(dtype=float))
    return Machine(current.codes, current.weights, slope, offset)


def score_toxicity(docs: DataFrame, labels: DataFrame, *, rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD,
                   folds: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score, predicted for every document.

    Null texts score as empty ones; a text without letters has the decision 0.
    Null ids are scored and not held out.  Repeated rows get equal scores.
    Without labels of both classes every score is the prior.  Labels, ids and
    other columns are no inputs; columns that clash in name with the results
    are ignored.  An empty table gives no rows.
    """
    machine = fit_toxicity(docs, labels, rows=rows, folds=folds, id_col=id_col, text_col=text_col)

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(machine.probability(np.array([machine.decision(t) for t in texts], dtype=float)))

    return docs.select(F.col(id_col), held_out(id_col, folds).alias("held_out"), score(text_of(text_col)).alias("score")) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op7_subsequence_kernel_toxicity(spark, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
