"""Subvector clusters, personal data behind disguises, spelling variants."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import clusters as C
from tidemark.llm import pii as P
from tidemark.llm import spelling as W

SF = "/root/testdata/sf0.001"

# ---- op11


def plain_clusters(rows, k=8, rounds=10, dims=64, seed=3):
    kept = [(i, [math.floor(float(x) * 1024) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if i is not None else "~"
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(x) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(centroids)]
    out = [(i, nearest(v)) for i, v in kept]
    far = collections.Counter()
    for _, (d, n) in out:
        far[n] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, far[n], sum(far.values()), digest[n]) for i, (d, n) in out), key=repr)


def got_clusters(df):
    return sorted((tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


def test_cluster_query_is_the_plain_one(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert got_clusters(C.op11_subvector_clusters(spark, SF)) == plain_clusters(rows)


def test_clusters_of_odd_rows(spark):
    rng = random.Random(5)
    base = [[rng.choice([-0.5, -0.25, 0.0, 0.125]) for _ in range(64)] for _ in range(6)]
    rows = [(i, base[i % 6]) for i in range(30)] + [(i, [rng.uniform(-1, 1) for _ in range(64)]) for i in range(30, 50)]
    rows += [(50, None), (51, [0.1] * 63), (52, [None] + [0.1] * 63), (53, [float("nan")] + [0.0] * 63), (54, [float("inf")] * 64),
             (55, []), (None, base[0]), (3, base[3]), (3, base[3]), (7, base[2]), (None, None)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, cluster int, distance string")
    plain = [(i, v and [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    for parts in (1, 5):
        for width in (1, 8, 64):
            assert got_clusters(C.cluster_vectors(df.repartition(parts), width=width)) == plain_clusters(plain)
    few = df.where("vec_id in (1, 2, 50)")
    assert {r["inertia"] for r in C.cluster_vectors(few).collect()} == {0} and C.cluster_vectors(few).count() == 2
    none = C.cluster_vectors(df.limit(0))
    assert none.count() == 0 and none.columns == C.cluster_vectors(few).columns
    with pytest.raises(Exception, match="no exact distance"):
        C.cluster_vectors(spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<float>")).count()


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 40), st.integers(1, 17), st.integers(1, 9), st.integers(1, 4), st.integers(0, 99))
def test_dictionaries_are_lossless(rows, dims, width, values, seed):
    a = np.random.default_rng(seed).integers(-values, values, (rows, dims)).astype(np.int32)
    blocks = list(C.encode_block(a, width))
    assert (np.hstack([d[c] for d, c in blocks]) == a).all()
    assert all(d.shape[1] == 1 or 2 * len(d) <= rows for d, _ in blocks)
    assert all(len(np.unique(d, axis=0)) == len(d) for d, _ in blocks)


# ---- op12

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_pii(text):
    digits = lambda m: [int(c) for c in m[0] if c in "0123456789"]

    def card(m):
        d = digits(m)[::-1]
        return 12 <= len(d) <= 19 and sum(sum(divmod(2 * x, 10)) if i % 2 else x for i, x in enumerate(d)) % 10 == 0

    tests = (EMAIL, lambda m: True), (IP, lambda m: all(int(p) <= 255 for p in m[0].split("."))), (CARD, card), \
        (PHONE, lambda m: 9 <= len(digits(m)) <= 15)
    got = sorted((m.start(), n, m.end()) for n, (p, ok) in enumerate(tests) for m in p.finditer(text) if ok(m))
    return [(P.KINDS[n], s, e) for s, n, e in got]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(["a", "b.c", "@", "x-y", ".", "com", "12", "255", "256", "1", "0.0", "+", "-", " ", "(", ")", "4041894974608795",
                                 "4041", "8949", "7460 ", "8795", "00", "٣", "é", "%", "_", "\n", "999999999"]), max_size=16).map("".join))
def test_base_kinds_are_the_plain_patterns(text):
    assert P.find(text) == plain_pii(text)


DISGUISED = [
    ("email", "joe.doe [at] mail5.example [dot] com", "joe.doe@mail5.example.com"),
    ("email", "joe at mail dot example dot com", "joe@mail.example.com"),
    ("email", "hsr.29 at mail5.example.com", "hsr.29@mail5.example.com"),
    ("email", "joe (AT) mail (DOT) com", "joe@mail.com"),
    ("email", "joe_at_mail_dot_com", "joe@mail.com"),
    ("email", "joe -at- mail -dot- com", "joe@mail.com"),
    ("email", "joe&#64;mail&#46;com", "joe@mail.com"),
    ("email", "joe @ mail . com", "joe@mail.com"),
    ("email", "jоe@mаil.example.com", "joe@mail.example.com"),
    ("email", "joe＠mail．com", "joe@mail.com"),
    ("email", "joe arroba mail punto es", "joe@mail.es"),
    ("card", "four zero four one eight nine four nine seven four six zero eight seven nine five", None),
    ("card", "４０４１８９４９７４６０８７９５", "4041894974608795"),
    ("card", "4O41 8949 746O 8795", "4041 8949 7460 8795"),
    ("card", "vier null vier eins 8949 7460 acht sieben neun fünf", None),
    ("card", "4041​8949​7460​8795", "4041894974608795"),
    ("phone", "plus one nine eight eight, double five five, two four eight five", None),
    ("phone", "+1 (nine eight eight) 555-2485", "+1 (9 8 8) 555-2485"),
    ("ip", "one nine two dot one six eight dot zero dot one", "192.168.0.1"),
    ("ip", "42[.]144[.]35[.]254", "42.144.35.254"),
    ("ip", "42 dot 144 dot 35 dot 254", "42.144.35.254"),
]


@pytest.mark.parametrize("kind,text,value", DISGUISED)
def test_disguises_are_seen_through_and_mapped_back(kind, text, value):
    for left, right in (("", ""), ("Ünï 😀 ​ see: ", " ; end"), ("aller, ", "\nnext line")):
        whole = left + text + right
        got = [(k, whole[s:e], v) for k, s, e, v in P.added(whole, P.find(whole))]
        assert [g for g in got if g[0] == kind] == [(kind, text, value or got[0][2])]


@pytest.mark.parametrize("text", [
    "look at example.com today", "at, at at of and ndon", "meet us at the dot. com is a word", "one two three go", "un de un, deux par deux",
    "at 10.30 or at 12.45", "joe@mail.com +1 (988) 555-2485 4041894974608795", "", " ", "a​b ­ c", "Ключ at дом", "@ . @ ."])
def test_plain_text_gets_no_added_span(text):
    assert P.added(text, P.find(text)) == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abо０1O. @​-+", max_size=30), st.integers(0, 5))
def test_tapes_keep_their_offsets(text, seed):
    tape = P.Tape.of(text)
    for t in P.TRANSDUCERS:
        tape = t(tape)
        assert len(tape.text) == len(tape.starts) == len(tape.ends) == len(tape.rewritten)
        assert (tape.starts < tape.ends).all() and (np.diff(tape.starts) >= 0).all() and (np.diff(tape.ends) >= 0).all()
        plain = [i for i in range(len(tape.text)) if not tape.rewritten[i]]
        assert all(text[tape.starts[i]:tape.ends[i]] == tape.text[i] for i in plain)


def test_long_texts_take_time_in_proportion():
    for text in ("a" * 300_000, "1" * 300_000, "+1" + "(" * 300_000, "one " * 50_000, " at " * 50_000, "@" * 100_000, "a@" * 50_000,
                 "1." * 100_000, "​" * 100_000, "4O" * 100_000, "+" * 100_000, ". " * 100_000, "(" * 100_000, "-" * 100_000,
                 "\t" * 50_000, "a" + " " * 50_000 + "b"):
        P.added(text, P.find(text))


def test_pii_query_and_odd_rows(spark, docs, odd):
    got = {r["doc_id"]: r for r in P.op12_offset_preserving_pii(spark, SF).collect()}
    assert len(got) == docs.count()
    for r in docs.collect():
        want = plain_pii(r["text"] or "")
        row = got[r["doc_id"]]
        assert row["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in P.KINDS] == [sum(k == x for x, _, _ in want) for k in P.KINDS]
        assert set(f"{k}:{s}:{e}" for k, s, e in want) <= set(row["spans"].split(","))
    out = P.find_personal_data(odd)
    assert out.columns == ["doc_id", "spans"] and out.count() == odd.count()
    assert P.find_personal_data(odd.limit(0)).count() == 0
    assert {len(r["spans"]) for r in out.where("doc_id is null or doc_id in (3, 4, 5)").collect()} == {0}
    one = spark.createDataFrame([(None, "mail joe (at) x.org", "p")], "doc_id long, text string, path string")
    row = P.find_personal_data(one, id_cols=("path", "doc_id")).collect()[0]
    assert (row["path"], row["doc_id"]) == ("p", None)
    assert [tuple(s) for s in row["spans"]] == [("email", 5, 19, "joe@x.org", False)]


# ---- op13


def plain_words(rows, noise=31):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if noise and h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def plain_spellings(words, ratio=10):
    near = collections.defaultdict(list)
    by_length = collections.defaultdict(list)
    for w in words:
        by_length[len(w)].append(w)
    for w in words:
        for size in (len(w) - 1, len(w), len(w) + 1):
            near[w] += [o for o in by_length[size] if one_apart(w, o)]
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= ratio * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def got_spellings(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abc", max_size=7), max_size=25, unique=True))
def test_the_scan_finds_all_near_pairs(words):
    words = sorted(words)
    got = sorted(W.near_pairs(words))
    assert got == [(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if one_apart(words[i], words[j])]


def test_spelling_query_is_the_plain_one(spark, docs):
    want = plain_spellings(plain_words([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert got_spellings(W.op13_sorted_list_spellings(spark, SF)) == want
    assert sum(1 for r in want if r[1]) > 5


def variants(seed, count=500):
    """Words of a few letters around few stems, many of them near each other, with chains of forms."""
    rng = random.Random(seed)
    out = collections.Counter()
    for stem in ("aaaaaaa", "abcabcab", "customerxyz", "ÿàaÿàaÿà"):
        word = stem
        for _ in range(count // 4):
            at = rng.randrange(len(word))
            word = rng.choice([word[:at] + rng.choice("abcÿ") + word[at + rng.randrange(2):], stem, word, word[:at] + word[at + 1:]])
            if len(word) < 7:
                word = stem
            out[word] = 2 * 10 ** rng.choice([0, 0, 0, 0, 1, 1, 2])
    return out


@pytest.mark.parametrize("most", [1, 3, 10_000])
def test_split_lists_lose_no_pair(spark, most):
    """A hot list is split as often as it takes: with ``most`` = 1 down to one free place."""
    words = variants(most)
    df = spark.createDataFrame([(w, n) for w, n in words.items()], "word string, n long")
    near = {r["word"]: (r["n_near"], r["best_n"], r["best"]) for r in W.scan_lists(W.lists(df, most)).collect()}
    for w in words:
        all_near = [o for o in words if one_apart(w, o)]
        best = min(((-words[o], o) for o in all_near), default=None)
        assert near.get(w) == (all_near and (len(all_near), -best[0], best[1]) or None)
    if most == 1:
        sizes = W.lists(df, most).groupBy(*W.LIST).count().where("hi - lo > 1").agg({"count": "max"}).collect()[0][0]
        assert sizes == 1


def test_lists_across_batches(spark):
    words = variants(9, 300)
    df = spark.createDataFrame([(w, n) for w, n in words.items()], "word string, n long")
    whole = sorted(map(tuple, W.scan_lists(W.lists(df)).collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert sorted(map(tuple, W.scan_lists(W.lists(df)).collect())) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_chains_of_forms(spark):
    names = [f"chain{chr(97 + i)}" for i in range(20)]
    forms = spark.createDataFrame(list(zip(names, names[1:])) + [("other", names[3])], "word string, form string")
    assert {tuple(r) for r in W.last_forms(forms).collect()} == {(n, names[-1]) for n in names[:-1] + ["other"]}
    assert W.last_forms(forms.limit(0)).count() == 0


def test_spellings_of_odd_rows(spark, odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for noise in (31, 2):
        assert got_spellings(W.group_spellings(odd, noise=noise)) == plain_spellings(plain_words(rows, noise))
    assert W.group_spellings(empty).count() == 0
    long = "ab" * 20_000
    few = spark.createDataFrame([(1, f"{long} {long} {long}c {long}c"), (2, None)], "doc_id long, text string")
    assert sorted((len(r["word"]), r["n_near"]) for r in W.group_spellings(few, least_count=2).collect()) == [(40_000, 1), (40_001, 1)]
