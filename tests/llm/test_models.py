"""Quality, toxicity and language model."""

import itertools
import math
import pickle
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from tidemark.llm import language_model as L
from tidemark.llm import quality as Q
from tidemark.llm import toxicity as X

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_trees_fit_and_flatten():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    trees = Q.fit_trees(x, y, trees=30)
    assert ((trees.probability(x) > 0.5) == y).mean() > 0.98
    inner = trees.feature.shape[1]
    for row, want in zip(x[:20], trees.log_odds(x[:20])):
        total = trees.base
        for t in range(len(trees.feature)):
            i = 0
            while i < inner:
                i = 2 * i + 1 + (row[trees.feature[t, i]] > trees.threshold[t, i])
            total += trees.value[t, i - inner]
        assert total == pytest.approx(want)
    assert Q.fit_trees(x[:0], y[:0]).probability(x[:2]).tolist() == [0.5, 0.5]
    assert len(Q.fit_trees(x, np.ones(len(x))).probability(x)) == len(x)


def test_quality_on_the_held_out_fold(tables):
    docs, labels = tables
    got = Q.score_quality(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    assert (got["held_out"] == got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    held = got[got["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() > 0.9
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.3)).all()


def test_toxicity_on_the_held_out_fold(tables):
    docs, labels = tables
    got = X.score_toxicity(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    held = got[got["held_out"]]
    assert (held["predicted"] == held["toxic"]).mean() > 0.85
    assert got["score"].between(0, 1).all()


def test_toxicity_tolerates_gaps(spark):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("aeourstlnk"), rng.integers(2, 7))) for _ in range(400)]
    insults = ["blockhead", "nincompoop", "dunderpate"]

    def text(bad):
        w = list(rng.choice(words, 40))
        if bad:
            w[rng.integers(0, 40)] = str(rng.choice(insults))
        return " ".join(w)

    rows = [(i, text(i % 3 == 0)) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(900)], "doc_id long, toxic int")
    machine = X.fit_toxicity(docs, labels)
    judge = lambda t: machine.probability(np.array([machine.decision(t)]))[0]
    clean = " ".join(words[:30])
    assert judge(clean) < 0.5
    for bad in ("blockhead", "b l o c k h e a d", "blo-ckhe.ad", "nincomxpoop", "dunderrpate", "blxockxhead", "duxndexrpaxte", "blocckkhead"):
        assert judge(f"{clean} {bad} {clean}") >= 0.5, bad

    def found(letters):
        """The share of insults found with so many letters put in anywhere within them."""
        got = []
        for _ in range(60):
            bad = list(str(rng.choice(insults)))
            for _ in range(letters):
                bad.insert(int(rng.integers(1, len(bad))), str(rng.choice(list("bcdfghjmpqvwxyz"))))
            got.append(judge(f"{clean} {''.join(bad)} {clean}") >= 0.5)
        return np.mean(got)

    assert found(0) == 1 and found(1) > 0.9 and found(2) > 0.7


def test_kernel_table_is_the_landmark_expansion():
    strings = [X.symbols(t) for t in ("stupid", "idiot fool", "plain")]
    codes, feats = X._matrix(strings)
    beta = np.array([0.5, -1.0, 2.0])
    weights = np.zeros(X.ALPHABET**X.ORDER, dtype=np.float32)
    weights[codes] = beta @ feats
    probe = X.symbols("a stupied idoit")
    f = X.phi(probe)
    by_kernel = sum(b * sum(f.get(int(c), 0.0) * v for c, v in zip(codes, row)) for b, row in zip(beta, feats))
    assert X.along(probe, weights).sum() == pytest.approx(by_kernel, rel=1e-4)


def plain_kernel(a, b):
    """Common subsequences of ORDER symbols, each pair of occurrences weighted by DECAY to the lengths that they span."""
    def occurrences(s):
        out = defaultdict(float)
        for at in itertools.combinations(range(len(s)), X.ORDER):
            span = at[-1] - at[0] + 1
            if span <= X.SPAN and X.BREAK not in [s[i] for i in at]:
                out[tuple(int(s[i]) for i in at)] += X.DECAY**span
        return out

    x, y = occurrences(a), occurrences(b)
    return sum(v * y[k] for k, v in x.items())


def test_features_give_the_plain_subsequence_kernel():
    texts = ["idiot", "ixdxixoxt", "an idiot", "you moron. fool", "aaaaaaa", "a. b c d", "", "abc"]
    for a, b in itertools.product([X.symbols(t) for t in texts], repeat=2):
        fa, fb = X.phi(a), X.phi(b)
        assert sum(v * fb.get(c, 0.0) for c, v in fa.items()) == pytest.approx(plain_kernel(a, b), abs=1e-12)
    assert plain_kernel(X.symbols("idiot"), X.symbols("ixdxixoxt")) > 0  # a letter between every two


def test_decision_is_the_sum_over_landmarks():
    """The highest window of f(x) = sum of beta times the plain kernel with the normalised landmarks."""
    marks = [X.symbols(t) for t in ("idiot", "moron", "plain")]
    codes, feats = X._matrix(marks)
    beta = np.array([1.5, 0.7, -0.4])
    machine = X.Machine(codes, (beta @ feats).astype(np.float32), 1.0, 0.0)
    for text in ("such an idiot", "a mo-ron, plainly", "ixdxixoxt", "plain", "nothing here"):
        s = X.symbols(text)
        best = []
        for at in range(len(s)):
            # subsequences that start at the window's first symbols: those of the piece less those of the piece from there on
            piece, rest = s[at:at + X.STARTS + X.SPAN - 1], s[at + X.STARTS:at + X.STARTS + X.SPAN - 1]
            best.append(sum(b * (plain_kernel(piece, m) - plain_kernel(rest, m)) / math.sqrt(plain_kernel(m, m)) for b, m in zip(beta, marks)))
        assert machine.decision(text) == pytest.approx(max(best), abs=1e-4)


def test_linear_machine_is_at_its_minimum():
    """The gradient of the plain objective is zero, and no nearby weights do better."""
    rng = np.random.default_rng(4)
    z = rng.normal(size=(300, 6))
    y = (z[:, 0] + 0.5 * z[:, 1] + 0.3 * rng.normal(size=300) > 0.4).astype(int)
    w, b = X._linear_svm(z, y)

    def cost(v):
        sign, bad = np.where(y > 0, 1.0, -1.0), (y > 0).sum()
        weight = np.where(y > 0, 0.5 / bad, 0.5 / (len(y) - bad)) * len(y) * 10.0
        return (v[:-1] @ v[:-1] + 1e-6 * v[-1]**2) / 2 + (weight * np.maximum(0, 1 - sign * (z @ v[:-1] + v[-1]))**2).sum() / 2

    at = np.append(w, b)
    for i in range(len(at)):
        step = np.zeros(len(at))
        step[i] = 1e-4
        assert abs(cost(at + step) - cost(at - step)) / 2e-4 < 1e-3 * cost(at)
    assert all(cost(at) <= cost(at + d) for d in rng.normal(size=(200, len(at))) * 0.05)


def test_training_ships_no_table(spark, tables):
    """What a fitted machine sends along is small: the table is spread in the worker."""
    machine = X.Machine(np.arange(3000), np.ones(3000, dtype=np.float32), 1.0, 0.0)
    machine.decision("some text")
    assert len(pickle.dumps(machine)) < 100_000


def test_models_on_odd_rows(spark, odd, empty):
    some = spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 1, 1), (7, 0, 1), (8, 1, 0), (8, 1, 0), (9, 0, 1)],
                                 "doc_id long, quality int, toxic int")
    for score in (Q.score_quality, X.score_toxicity):
        for known in (some, some.limit(0)):
            got = score(odd, known).collect()
            assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
            assert len({r["score"] for r in got if r["doc_id"] == 8}) == 1
        assert score(empty, some).count() == 0


def plain_scores(texts, held, order, share):
    contexts, total = [defaultdict(Counter) for _ in range(order + 1)], 0
    for t, h in zip(texts, held):
        if not h:
            x = bytes([255] * order) + t + b"\xff"
            for i in range(order, len(x)):
                total += 1
                for j in range(order + 1):
                    contexts[j][x[i - j:i]][x[i]] += 1
    out = []
    for t in texts:
        x, s = bytes([255] * order) + t + b"\xff", 0.0
        for i in range(order, len(x)):
            out_of, done = set(), False
            for j in range(order, -1, -1):
                found = contexts[j].get(x[i - j:i], {})
                if j and sum(found.values()) < max(1.0, share * total):
                    continue
                left = {c: n for c, n in found.items() if c not in out_of}
                size, kinds = sum(left.values()), len(left)
                if not left:
                    continue
                if x[i] in left:
                    s += math.log10(left[x[i]] / (size + kinds))
                    done = True
                    break
                s += math.log10(kinds / (size + kinds))
                out_of |= set(left)
            if not done:
                s += math.log10(1 / (256 - len(out_of)))
        out.append(s)
    return out


def test_language_model_against_a_plain_one(spark, monkeypatch, docs):
    for share in (L.CONTEXT_SHARE, 3e-3):
        rows = docs.orderBy("doc_id").limit(60).collect()
        texts = [(r["text"] or "").encode().lower() for r in rows]
        held = [zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in rows]
        raws = [t for t, h in zip(texts, held) if not h]
        codes, n = L.grams(raws)
        entries, total = [], n.sum()
        for j in range(L.ORDER + 1):
            u, at = np.unique(codes & ((1 << 8 * (j + 1)) - 1), return_inverse=True)
            m = np.bincount(at, weights=n)
            if j:
                _, at = np.unique(u >> 8, return_inverse=True)
                keep = np.bincount(at, weights=m)[at] >= max(1.0, share * total)
                u, m = u[keep], m[keep]
            entries.append((u, m))
        got = L.build(entries).score(texts + [b"", "unseen 漢字".encode()])
        assert got == pytest.approx(plain_scores(texts + [b"", "unseen 漢字".encode()], held + [True, True], L.ORDER, share), rel=1e-5)


def test_language_model_hands_on_few_rows_at_once(spark, monkeypatch, docs):
    monkeypatch.setattr(L, "SEND_ROWS", 500, raising=False)
    monkeypatch.setattr(L, "FLUSH_GRAMS", 3000)
    runs, real = [], type(docs).mapInPandas
    monkeypatch.setattr(type(docs), "mapInPandas", lambda self, run, schema, **k: runs.append(run) or real(self, run, schema, **k))
    L.training_counts(docs.limit(1), "text", L.held_out("doc_id", 10))
    texts = [r["text"] or "" for r in docs.limit(60).collect()]
    batches = [pd.DataFrame({"text": texts[i:i + 20], "trains": [j % 3 > 0 for j in range(20)]}) for i in (0, 20, 40)]
    frames = [f for f in runs[0](iter(batches)) if f["word"].isna().all()]
    assert len(frames) > 2 and max(map(len, frames)) <= 500
    n, met = Counter(), Counter()
    for f in frames:
        for code, a, b in zip(f["code"], f["n"], f["met"]):
            n[code] += a
            met[code] += b
    plain = [Counter(), Counter()]
    for i, t in enumerate(texts):
        for code in L.positions([t.encode("utf-8", "replace").lower()]).tolist():
            plain[1][code] += 1
            plain[0][code] += i % 20 % 3 > 0
    assert [+n, met] == [+plain[0], plain[1]]


def test_language_model_keeps_every_context(spark, monkeypatch, docs):
    """A context of few occurrences predicts too, however large the corpus; grams sent along or joined give the same."""
    rows = docs.orderBy("doc_id").limit(80).select("doc_id", "text").collect()
    rows += [(1_000_000 + i, t) for i, t in enumerate(["unseen 漢字 qzxj", "", "zebra zebra"])]
    filler = next(i for i in range(2_000_000, 2_000_100) if zlib.crc32(str(i).encode()) % 10)
    rows.append((filler, "a" * 600_000))  # CONTEXT_SHARE of all symbols is more than three
    texts = [(r[1] or "").encode().lower() for r in rows]
    held = [zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows]
    want = plain_scores(texts, held, L.ORDER, 0)
    frame = spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string")
    for share in (2e-7, 1e-4, 1.0):
        monkeypatch.setattr(L, "GRAM_SHARE", share, raising=False)
        got = {r["doc_id"]: r["score"] for r in L.score_documents(frame).collect()}
        assert [got[r[0]] for r in rows] == pytest.approx(want, rel=1e-6)


def test_language_model_query(spark, tables):
    docs, _ = tables
    got = L.score_documents(docs).toPandas().set_index("doc_id")
    rows = docs.collect()
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in rows}
    words = {r["doc_id"]: (r["text"] or "").encode().lower().split() + [b""] for r in rows}
    counts = Counter(w for i, ws in words.items() if not held[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in words.items():
        r = got.loc[i]
        want = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert r["base_score"] == pytest.approx(want, rel=1e-9) and r["held_out"] == held[i]
        assert r["n_tokens"] == len(ws) and r["n_known"] == sum(counts[w] > 0 for w in ws) and r["train_tokens"] == n


def test_language_model_on_odd_rows(odd, empty, spark):
    got = L.score_documents(odd).collect()
    assert len(got) == odd.count() and sum(r["doc_id"] is None for r in got) == 2
    assert len({(r["score"], r["base_score"]) for r in got if r["doc_id"] == 8}) == 1
    blank = [r for r in got if r["doc_id"] in (3, 4)]
    assert {r["n_tokens"] for r in blank} == {1} and len({r["score"] for r in blank}) == 1
    assert L.score_documents(empty).count() == 0
    only = spark.createDataFrame([(23, "held out only")], "doc_id long, text string")  # crc32('23') % 10 == 0 or not: both must work
    assert L.score_documents(only).count() == 1
