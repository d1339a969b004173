"""Secret scans (ledger), token counts, decontamination."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import decontaminate as D
from tidemark.llm import secrets as S
from tidemark.llm import tokens as K
from tidemark.session import fresh_path

SF = "/root/testdata/sf0.001"
KEY = "[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]"
PLAIN = [("assign", re.compile(f"({KEY})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 8),
         ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32)]


def plain_base(text):
    got = sorted((m.start(), n, m.end(), k) for n, (k, p, ok) in enumerate(PLAIN) for m in p.finditer(text) if ok(m))
    return [(k, s, e) for s, _, e, k in got]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "TOKEN", "api_key", "apikey", "secret", "ſecret", "=", ":", " ", '"', "'", "AKIA", "ABCD1234",
                                 "0123456789abcdef", "deadbeef", "x", ".", "\n", "abc", "g"]), max_size=14).map("".join))
def test_base_kinds_match_the_plain_patterns(text):
    order = [r.kind for r in S.BASE]
    got = sorted(S.find(text, S.BASE), key=lambda s: (s[1], order.index(s[0])))
    assert got == plain_base(text)


def test_userinfo_of_any_length():
    for user, password in (("u", "github_pat_" + "A1b2" * 21), ("u" * 200, "p" * 5000), ("me", "abc")):
        text = f"see https://{user}:{password}@host/x"
        assert ("userinfo", 9, text.index("@") + 1) in S.find(text, S.RULES)
    assert ("prefixed", 2, 95) in S.find("= github_pat_" + "A" * 22 + "_" + "b" * 59 + " ", S.RULES)
    for text in ("http://a/b:ccc@d", "://a:cc@d", "://a b:ccc@d", "://" + "a" * 100_000, "://a:" + "b" * 100_000):
        assert "userinfo" not in {k for k, _, _ in S.find(text, S.RULES)}


def test_secret_query_matches_plain_scan(spark, docs):
    got = {r["doc_id"]: r for r in S.op1_blob_ledger_secrets(spark, SF).collect()}
    for r in docs.collect():
        want = plain_base(r["text"] or "")
        assert got[r["doc_id"]]["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest()
        assert got[r["doc_id"]]["n_hex"] == sum(k == "hex" for k, _, _ in want)


def test_ledger_scans_only_unseen_pairs(spark):
    folder = fresh_path(spark, "test-ledger")
    rows = [(1, 1, "token = abcdefgh12"), (1, 2, "token = abcdefgh12"), (2, 1, "nothing"), (3, 1, "AKIA" + "A" * 16)]
    first = spark.createDataFrame(rows, "path long, revision long, text string")
    got = S.scan(first, folder, rules=S.BASE[:1], id_cols=("path", "revision")).collect()
    assert sorted((r["path"], r["revision"], len(r["spans"])) for r in got) == [(1, 1, 1), (1, 2, 1), (2, 1, 0), (3, 1, 0)]
    assert S.read_ledger(spark, folder).count() == 3  # equal texts are one blob
    S.scan(first, folder, rules=S.BASE[:1], id_cols=("path", "revision"))
    assert S.read_ledger(spark, folder).count() == 3  # nothing new
    more = first.union(spark.createDataFrame([(4, 1, "secret: 'longenough'")], first.schema))
    got = S.scan(more, folder, rules=S.BASE[:2], id_cols=("path", "revision")).collect()
    ledger = S.read_ledger(spark, folder).collect()
    assert sorted(tuple(r["rules"]) for r in ledger) == [("access@1",)] * 3 + [("assign@1",)] * 3 + [("assign@1", "access@1")]
    assert {(r["path"], s["kind"]) for r in got for s in r["spans"]} == {(1, "assign"), (3, "access"), (4, "assign")}
    raised = [S.Rule("assign", 2, r"(token)", 1, 0)]
    got = S.scan(first, folder, rules=raised, id_cols=("path", "revision")).collect()
    assert {(s["start"], s["end"]) for r in got for s in r["spans"]} == {(0, 5)}  # the old version's span is gone


def test_secret_odd_rows(spark, odd, empty):
    got = S.scan(odd, fresh_path(spark, "test-ledger"))
    assert got.count() == odd.count() and got.where("doc_id is null").count() == 2
    assert S.scan(empty, fresh_path(spark, "test-ledger")).count() == 0


def test_attribution_rules():
    import numpy as np
    starts, ends, bounds = np.array([0, 2, 6]), np.array([2, 6, 8]), np.array([0, 3, 3, 8])
    assert K.attribute(starts, ends, bounds, "first").tolist() == [2, 0, 1]
    assert K.attribute(starts, ends, bounds, "most").tolist() == [1, 0, 2]
    assert K.attribute(starts, ends, bounds, "share").tolist() == [1.25, 0, 1.75]


def test_token_counts_add_up_and_match_a_plain_count(docs):
    import tiktoken
    ranks = K.read_vocabulary(K.VOCABULARY)
    encoder = tiktoken.Encoding("own", pat_str=K.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = K.count_tokens(docs).toPandas()
    totals = got.groupby("doc_id").agg(n=("n_tokens", "sum"), d=("doc_tokens", "first"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert (totals["n"] == totals["d"]).all() and set(totals.index) == set(texts)
    for doc_id in sorted(texts)[:25]:
        raw, at, plain = texts[doc_id].encode(), 0, {}
        for token in encoder.encode_ordinary(texts[doc_id]):
            line = raw[:at].count(b"\n")
            plain[line] = plain.get(line, 0) + 1
            at += len(encoder.decode_single_token_bytes(token))
        own = got[(got["doc_id"] == doc_id) & (got["n_tokens"] > 0)]
        assert dict(zip(own["section"], own["n_tokens"])) == plain
        pieces = [raw[s:e] for s, e in got[got["doc_id"] == doc_id].sort_values("section")[["start", "end"]].to_numpy()]
        assert b"".join(pieces) == raw


def test_token_fields_and_odd_rows(spark, odd, empty):
    for rule in K.RULES:
        got = K.count_tokens(odd, fields=("text", "lang"), rule=rule).toPandas()
        assert got["doc_id"].isna().sum() == 4
        whole = got[got["doc_id"] == 1]
        assert whole["n_tokens"].sum() == whole["doc_tokens"].iloc[0] * 1 and set(whole["field"]) == {"text", "lang"}
    assert K.count_tokens(empty).count() == 0


def plain_distance(p, t):
    best, row = len(p), [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        new = [i]
        for j, d in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=12), st.text("abc", max_size=30))
def test_bit_parallel_distance(p, t):
    got = D.best_match(D.masks(p), len(p), t, len(p))
    assert (got[0] if got else len(p)) == plain_distance(p, t)


@settings(max_examples=200, deadline=None)
@given(st.permutations("abcdefghijklmno"), st.permutations("abcdefghijklmno"), st.integers(0, 14), st.integers(0, 14), st.text("xyz", max_size=40))
def test_repeated_pieces_at_the_end_of_a_text(p, q, i, j, before):
    p, q = "".join(p), "".join(q)
    item = p + q + p
    text = before + p[:i] + "0" + p[i + 1:] + q[:j] + "1" + q[j + 1:] + p  # the last p hits the first piece and the third
    got = D.Block([(1, item)], D.ERRORS, D.LEAST).find(text)
    assert [d for _, _, _, d in got] == [plain_distance(item, text)]


def test_leaks_with_edits(spark):
    item = "Which of the following rivers flows through the largest number of countries on its way to the sea, and why?"
    edits = item.replace("largest", "laargest").replace("countries", "contries")
    far = item.replace("largest number", "most").replace("countries", "states").replace("sea", "ocean")
    rows = [(1, f"Before. {item} After."), (2, item.upper().replace(" ", " *** ")), (3, f"x {edits} y"), (4, f"x {far} y"), (5, None),
            (6, ""), (7, item[: len(item) // 2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(11, item), (12, None), (13, ""), (14, "tiny one"), (11, item)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in D.find_leaks(docs, items).collect()}
    assert set(got) == {(1, 11), (2, 11), (3, 11)}
    assert got[1, 11]["distance"] == 0 and got[3, 11]["distance"] == 2
    start, end = got[1, 11]["start"], got[1, 11]["end"]
    assert rows[0][1][start:end] == item[:-1]
    assert [r["doc_id"] for r in D.without_leaks(docs, items).orderBy("doc_id").collect()] == [4, 5, 6, 7]


def test_leak_query_matches_plain_search(spark, docs):
    got = {(r["doc_id"], r["item_id"]) for r in D.op5_pigeonhole_leaks(spark, SF).collect()}
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    plain = set()
    for d in docs.collect():
        folded = D.fold(d["text"] or "")
        for i in items:
            if D.fold(i["text"]) in folded:
                plain.add((d["doc_id"], i["item_id"]))
    assert plain <= got
    by_id = {d["doc_id"]: D.fold(d["text"] or "") for d in docs.collect()}
    for doc_id, item_id in got - plain:
        item = D.fold(next(i["text"] for i in items if i["item_id"] == item_id))
        assert D.best_match(D.masks(item), len(item), by_id[doc_id], int(len(item) * D.ERRORS)) is not None


def test_leak_odd_rows(odd, empty, spark):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert D.find_leaks(odd, items).count() == 0 and D.find_leaks(empty, items).count() == 0
    assert D.find_leaks(odd, items.limit(0)).count() == 0
    assert D.without_leaks(odd, items).count() == odd.count()


def test_short_items_match_whole_words_only(spark):
    docs = spark.createDataFrame([(1, "the party was fun"), (2, "modern ART, they say"), (3, "ar t"), (4, "art"), (5, "start"),
                                  (6, "yesterday: y-e-s!"), (7, "oh yes"), (8, "partyart art")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "art"), (2, "Yes!")], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["start"], r["end"]) for r in D.find_leaks(docs, items).collect())
    assert got == [(2, 1, 7, 10), (3, 1, 0, 4), (4, 1, 0, 3), (6, 2, 11, 16), (7, 2, 3, 6), (8, 1, 9, 12)]
    assert sorted(r["doc_id"] for r in D.without_leaks(docs, items).collect()) == [1, 5]


def test_samples_hold_one_text_an_id(spark):
    from tidemark.llm.common import training_sample
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(i, "other") for i in range(2, 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(1, 40)], "doc_id long, toxic int")
    got = training_sample(docs, labels, "toxic", rows=100).collect()
    assert len(got) == len({r["_id"] for r in got}) and all(r["_label"] == 1 for r in got)
