"""Near-duplicates, mixing, fingerprints, sharding, and the pipeline."""

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tidemark.llm import components as C
from tidemark.llm import decontaminate, fingerprints, mixing, near_duplicates, quality, shards
from tidemark.llm.common import staged

SF = "/root/testdata/sf0.001"


def explain_text(df):
    return df._jdf.queryExecution().toString()


def shingle_set(text, width):
    words = (text or "").encode().lower().split()
    width = min(width, len(words))
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if words else set()


def plain_components(rows, width, percent=80):
    """rows: [(id, text)] with distinct ids."""
    sets = {i: shingle_set(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def test_components_of_chains_stars_and_rings(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    ring = [(2000 + i, 2000 + (i + 1) % 17) for i in range(17)]
    links = spark.createDataFrame(chain + star + ring + [(5, 5)], "a long, b long")
    got = {r["node"]: r["component"] for r in C.components(links).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[1000 + i] for i in range(50)} == {1000}
    assert {got[2000 + i] for i in range(17)} == {2000}
    assert C.components(links.limit(0)).count() == 0


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_match_all_pairs(spark, docs, width):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want, sizes = plain_components(rows, width)
    for r in near_duplicates.near_duplicates(docs, width=width).collect():
        assert (r["component_id"], r["n_shingles"], r["kept"]) == (want[r["doc_id"]], sizes[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])


@pytest.mark.parametrize("common", [25, 24, 22])
def test_near_duplicates_with_a_low_estimate(spark, common):
    """Exactly at the threshold, with few common values in the sketch of the union."""
    words = sorted((f"w{i}" for i in range(2000)), key=lambda w: near_duplicates.shingles(w, 1)[0])
    own = near_duplicates.K - common  # the least hashes are in one of the texts only
    own, shared = words[:own], words[own:5 * own]
    texts = [" ".join(own[::2] + shared), " ".join(own[1::2] + shared)]
    a, b = (set(t.split()) for t in texts)
    assert len(a & b) * 100 == len(a | b) * 80
    got = near_duplicates.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), width=1)
    assert {r["component_id"] for r in got.collect()} == {0}


def test_near_duplicates_in_groups(spark):
    """Families of copies that are alike only by chains, among short texts of common words."""
    rng = np.random.default_rng(5)
    rows, words = [], [f"w{i}" for i in range(500)]
    for family in range(4):
        base = list(rng.choice(words, 120))
        for copy in range(25):
            base[int(rng.integers(0, 120))] = f"c{family}x{copy}"
            rows.append((family * 100 + copy, " ".join(base)))
    rows += [(1000 + i, " ".join(rng.choice(words, 6))) for i in range(40)]
    want, _ = plain_components(rows, 2)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()}
    assert got == want and len(set(want.values())) < 60


def test_near_duplicates_in_a_family_of_every_similarity(spark):
    """Hundreds of copies of one text, edited a little or a lot: most are linked, the others are alike but not enough."""
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in rng.integers(0, 400, 90)]
    rows = []
    for copy in range(400):
        words = list(base)
        for at in rng.choice(90, int(rng.integers(0, 24)), replace=False):
            words[at] = f"x{int(rng.integers(0, 60))}"
        rows.append((copy, " ".join(words)))
    want, _ = plain_components(rows, 2)
    assert 20 < len(set(want.values())) < 380
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()}
    assert got == want


def test_few_pairs_are_left_of_a_family(spark, monkeypatch):
    """The more a copy is edited, the later it stands; hubs are the originals, so few pairs are left for the last round."""
    rng = np.random.default_rng(13)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for copy in range(300):
        words = list(base)
        for at in rng.choice(90, copy * 12 // 300, replace=False):
            words[at] = f"x{int(rng.integers(0, 40))}"
        rows.append((copy, " ".join(words)))
    made, across = [], near_duplicates._across
    monkeypatch.setattr(near_duplicates, "_across", lambda *a: made.append(staged(across(*a), "made")) or made[0])
    want, _ = plain_components(rows, 2)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()}
    assert got == want
    assert made[0].count() < 1500


def test_wide_bitmaps_turn_down_pairs_just_below_the_threshold(spark):
    rng = np.random.default_rng(3)
    common = rng.integers(-2**62, 2**62, 850)
    a, near, far = (np.sort(np.concatenate([common, rng.integers(-2**62, 2**62, n)])) for n in (100, 100, 175))
    sets = spark.createDataFrame([(i, x.tolist(), near_duplicates.parity(x, near_duplicates.WIDE).tolist()) for i, x in enumerate((a, near, far))],
                                 "node long, set array<long>, wide array<long>")
    pairs = spark.createDataFrame([(0, 1), (0, 2)], "a long, b long")
    assert [len(np.intersect1d(a, x)) * 100 >= len(np.union1d(a, x)) * 80 for x in (near, far)] == [True, False]
    assert [tuple(r) for r in near_duplicates._close(pairs, sets, 80).collect()] == [(0, 1)]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(-2**63, 2**63 - 1), max_size=60), st.sets(st.integers(-2**63, 2**63 - 1), max_size=60),
       st.sets(st.integers(-2**63, 2**63 - 1), max_size=60))
def test_bitmaps_never_differ_in_more_bits_than_values(a, b, both):
    a, b = a | both, b | both
    bits = [near_duplicates.parity(np.array(sorted(s), dtype=np.int64)) for s in (a, b)]
    assert sum(int(x).bit_count() for x in (bits[0] ^ bits[1]).view(np.uint64)) <= len(a ^ b)


def test_near_duplicates_without_ids(spark):
    """Texts without ids are told apart by their hashes when they are read again."""
    rows = [(None, " ".join(f"t{i}w{j}" for j in range(60)) + tail) for i in range(40) for tail in ("", " end")] + [(5, "t0w0 t0w1")]
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()
    assert len(got) == 81 and {r["component_id"] for r in got} == {None, 5} and all(r["kept"] for r in got)
    left = near_duplicates.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2)
    assert left.count() == 81


def test_near_duplicates_odd_rows(odd, empty):
    got = near_duplicates.near_duplicates(odd, width=2).collect()
    assert len(got) == odd.count()
    by_id = defaultdict(list)
    for r in got:
        by_id[r["doc_id"]].append(r)
    assert by_id[2][0]["component_id"] == 1 and not by_id[2][0]["kept"]
    assert all(r["kept"] and r["n_shingles"] == 0 for i in (3, 4, 5) for r in by_id[i])
    assert all(r["kept"] and r["component_id"] is None for r in by_id[None])
    left = near_duplicates.drop_near_duplicates(odd, width=2)
    assert left.columns == odd.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in left.collect()) == sorted(
        {(r["doc_id"] or 0, r["text"] or "") for r in odd.collect() if r["doc_id"] != 2})
    assert near_duplicates.near_duplicates(empty, width=2).count() == 0


def test_mix_matches_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    want = con.execute(mixing.OP2_SQL).df().sort_values("doc_id").reset_index(drop=True)
    got = mixing.op2_curriculum_mix(spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    for c in want.columns:
        assert np.allclose(got[c].astype(float), want[c].astype(float), equal_nan=True), c


def test_targets_stop_at_three_times_the_source(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 5), ("d", 2000), (None, 1), ("é", 0)], "_source string, source_size long")
    got = {r["_source"]: r["target"] for r in mixing.source_targets(sizes, [1.0, 2.0, 3.0]).collect()}
    weights = {"a": 1.0, "b": 2.0, "c": 3.0, "d": 1.0, "é": 2.0, None: 3.0}
    caps = {"a": 3000, "b": 30, "c": 15, "d": 6000, "é": 0, None: 3}
    fixed, free = {}, dict(weights)
    while True:  # share, cap, share the excess again
        level = (3016 - sum(fixed.values())) / sum(free.values())
        over = {s for s in free if level * free[s] > caps[s]}
        if not over:
            break
        for s in over:
            fixed[s] = caps[s]
            del free[s]
    want = {**fixed, **{s: level * w for s, w in free.items()}}
    assert got == pytest.approx(want) and sum(got.values()) == pytest.approx(3016)


@settings(max_examples=60, deadline=None)
@given(st.floats(0, 1))
def test_due_time_inverts_the_integrated_schedule(y):
    for knots in mixing.SCHEDULES:
        total, t = mixing.integral(knots), None
        lo, hi = 0.0, 1.0

        def reached(x):
            s = 0.0
            for (a, u), (b, v) in zip(knots, knots[1:]):
                w = min(max(x - a, 0), b - a)
                s += w * u + (v - u) / (b - a) * w * w / 2
            return s / total

        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if reached(mid) < y else (lo, mid)
        t = hi
        assert reached(t) == pytest.approx(y, abs=1e-9)


def test_mix_positions_order_and_whole_documents(spark, docs):
    mixed = staged(mixing.mix(docs, whole=True), "test-mix")
    assert mixed.where("taken % size <> 0 and size > 0").count() == 0
    order = mixing.training_order(mixed)
    got = order.select("position", F.spark_partition_id().alias("p")).collect()
    ends = defaultdict(list)
    for r in got:
        ends[r["p"]].append(r["position"])
    flat = [x for p in sorted(ends) for x in ends[p]]
    assert flat == sorted(flat) and 0 <= flat[0] and flat[-1] <= 1
    words, kept = mixed.agg(F.sum("taken")).first()[0], order.agg(F.sum("words")).first()[0]
    assert words == kept
    # A source's copies follow its schedule: position is where its own demand reaches the copy's first word.
    one = mixed.where("source_size > 0").select("target", "source_size", F.explode("copies").alias("c")).limit(50).collect()
    assert all(0 <= r["c"]["position"] <= 1 for r in one)


def test_mix_odd_rows(odd, empty, spark):
    got = mixing.mix(odd, carry=("source",)).collect()
    assert len(got) == odd.count()
    assert all(r["taken"] <= 3 * r["size"] and (r["size"] > 0 or not r["copies"]) for r in got)
    by_source = {}
    for r in got:
        by_source.setdefault(r["source"], [r["target"], 0])[1] += r["taken"]
    assert all(abs(target - taken) <= 0.5 + 1e-9 for target, taken in by_source.values())
    assert mixing.mix(empty).count() == 0
    assert {(r["doc_id"], r["taken"]) for r in mixing.mix(odd).collect()} == {(r["doc_id"], r["taken"]) for r in got}


def test_fingerprints_match_plain_texts(spark, docs):
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), reverse=True)
    got = {r["doc_id"]: r for r in fingerprints.op8_i_match_fingerprints(spark, SF).collect()}
    assert len(got) == len(rows)
    seen = {}
    for n, (i, text) in enumerate(rows):
        after, half = rows[(n + 1) % len(rows)], len(text) // 2
        edited = text[: len(text) - half] + after[1][:half]
        r = got[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert seen.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        a, b = (x["fingerprint"].split("-") for x in (r, got[after[0]]))
        met = [(x, y) for x, y in zip(a, b) if x or y]
        assert r["near_next"] == pytest.approx(sum(x == y for x, y in met) / len(met) if met else 1.0)
    near = [r["near_edited"] for r in got.values()]
    assert np.mean(near) > 5 * np.mean([r["near_next"] for r in got.values()])


def test_fingerprint_values_against_a_plain_lexicon(spark, docs):
    """The whole-lexicon value is a function of the sorted in-band terms alone."""
    texts = docs.select("text")
    known = {r["term"] for r in fingerprints.lexicon(texts).collect()}
    rows = docs.select("doc_id", fingerprints.term_hashes(F.coalesce("text", F.lit(""))).alias("t")).collect()
    kept = {r["doc_id"]: tuple(sorted(set(r["t"]) & known)) for r in rows}
    got = {r["doc_id"]: r["fingerprint"].split("-")[0] for r in fingerprints.fingerprint_edits(docs).collect()}
    by_terms = defaultdict(set)
    for i, terms in kept.items():
        if terms:
            by_terms[terms].add(got[i])
    assert all(len(v) == 1 for v in by_terms.values()) and len(set().union(*by_terms.values())) == len(by_terms)


def test_fingerprint_odd_rows(odd, empty, spark):
    got = fingerprints.fingerprint_edits(odd).collect()
    assert len(got) == odd.count() and sum(r["doc_id"] is None for r in got) == 2
    assert {r["near_edited"] for r in got if r["doc_id"] in (3, 4)} == {1.0}
    assert fingerprints.fingerprint_edits(empty).count() == 0
    one = fingerprints.fingerprint_edits(odd.where("doc_id = 6")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"ono").hexdigest() and one["near_next"] == 1.0
    plan = explain_text(fingerprints.fingerprint_edits(odd))
    assert "Python" not in plan and "Pandas" not in plan


def test_buckets_of_the_id_order(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROWS_PER_BUCKET", 3)
    monkeypatch.setattr(fingerprints, "CHUNK", 4)
    ids = [int(i) for i in np.random.default_rng(3).integers(-10**12, 10**12, 97)] + [2**62, -(2**62)]
    rows = [(i, f"text {i} of words") for i in ids]
    got = {r["doc_id"]: r["edited_sha256"] for r in fingerprints.fingerprint_edits(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    rows.sort(reverse=True)
    for n, (i, t) in enumerate(rows):
        half = len(t) // 2
        assert got[i] == hashlib.sha256((t[: len(t) - half] + rows[(n + 1) % len(rows)][1][:half]).encode()).hexdigest()


@pytest.mark.parametrize("bounds", [5, 1000])
def test_repeated_ids_and_more_buckets_than_bounds(spark, monkeypatch, bounds):
    """A third of all rows under one id: split by text, still in order; stretches between bounds are divided."""
    monkeypatch.setattr(fingerprints, "ROWS_PER_BUCKET", 10)
    monkeypatch.setattr(fingerprints, "MOST_BOUNDS", bounds)
    ids = [int(i) for i in np.random.default_rng(4).integers(-10**6, 10**6, 400)] + [77] * 200
    df = spark.createDataFrame([(i, f"text {n} of words") for n, i in enumerate(ids)], "doc_id long, text string")
    rows, _ = fingerprints.in_order(df, "doc_id", "text")
    rows = rows.where("copy = 0").select("id", "h", "bucket", "text").collect()
    sizes = Counter(r["bucket"] for r in rows)
    assert sum(sizes.values()) == 600 and max(sizes.values()) <= (150 if bounds == 5 else 40)
    order = sorted(rows, key=lambda r: (-r["id"], -r["h"]))
    assert [r["bucket"] for r in order] == sorted(r["bucket"] for r in rows)
    want = Counter()
    for n, r in enumerate(order):
        half = len(r["text"]) // 2
        text = r["text"][: len(r["text"]) - half] + order[(n + 1) % len(order)]["text"][:half]
        want[r["id"], hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["edited_sha256"]) for r in fingerprints.fingerprint_edits(df).collect()) == want


def test_shards_and_slots(spark, docs):
    rows = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = shards.op9_hash_tree_shards(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(rows)
    slots = defaultdict(list)
    for r in got:
        raw = rows[r["doc_id"]].encode()
        assert r["size"] == len(raw) + 8 and r["text_crc32"] == zlib.crc32(raw) and r["law"] == "key"
        assert 0 <= r["shard"] < 24 and r["grown_shard"] in (r["shard"], 24)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def plain_shard(i, weights):
    """The descent in plain Python, with hashes of Spark's: {(level, node): u} is looked up per id."""
    def least(level, children):
        if len(children) == 1:
            return next(iter(children))
        return min(children, key=lambda n: (-np.log(i[level, n]) / children[n], n))

    rack_of, region_of = shards.SHARDS_PER_RACK, shards.SHARDS_PER_RACK * shards.RACKS_PER_REGION
    regions, racks = defaultdict(float), defaultdict(float)
    for s, w in weights.items():
        regions[s // region_of] += w
        racks[s // rack_of] += w
    region = least("region", regions)
    rack = least("rack", {r: w for r, w in racks.items() if r // shards.RACKS_PER_REGION == region})
    return least("shard", {s: w for s, w in weights.items() if s // rack_of == rack})


def test_descent_is_the_plain_one(spark):
    ids = spark.range(300).withColumnRenamed("id", "doc_id")
    names = [("region", 3), ("rack", 8), ("shard", 30)]
    draw = lambda level, n: F.exp(-shards.hash_draw(F.col("doc_id"), level, n, 1.0)).alias(f"{level}{n}")
    for n, weights in ((30, {}), (24, {3: 0.0, 5: 2.5, 17: 0.2}), (1, {})):
        given = {s: weights.get(s, 1.0) for s in range(n) if weights.get(s, 1.0) > 0}
        got = shards.place(ids.select("doc_id", *[draw(level, k) for level, count in names for k in range(count)]), n, weights=weights)
        for r in got.collect():
            us = {(level, k): r[f"{level}{k}"] for level, count in names for k in range(count)}
            assert r["shard"] == plain_shard(us, given)


def test_one_more_shard_takes_rows_into_itself(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    at = lambda n, **w: np.array([r["shard"] for r in shards.place(ids, n, **w).orderBy("doc_id").collect()])
    region = shards.SHARDS_PER_RACK * shards.RACKS_PER_REGION
    for n in (1, 3, 4, 8, 12, 13, 24, 30):
        a, b = at(n), at(n + 1)
        moved = a != b
        if shards.one_more_is_alone(n):
            assert set(b[moved]) <= {n}
        else:  # other counts: the region that the shard joins wins rows, and no other one
            assert set(b[moved] // region) == {n // region} and set(b[moved]) > {n}
        assert abs((b == n).mean() - 1 / (n + 1)) < 0.02
    assert [n for n in range(1, 40) if shards.one_more_is_alone(n)] == [1, 2, 3, 4, 8, 12, 24, 36]


def test_movement_is_confined_to_subtrees_whose_weight_changes(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    at = lambda **w: np.array([r["shard"] for r in shards.place(ids, 24, **w).orderBy("doc_id").collect()])
    per_rack, region = shards.SHARDS_PER_RACK, shards.SHARDS_PER_RACK * shards.RACKS_PER_REGION
    a = at()
    # Weight shifted within a rack: rows move between that rack's shards only.
    b = at(weights={5: 0.5, 6: 1.5})
    moved = a != b
    assert moved.any() and set(a[moved] // per_rack) == {1} == set(b[moved] // per_rack)
    assert abs((b == 5).mean() - 0.5 / 24) < 0.01 and abs((b == 6).mean() - 1.5 / 24) < 0.01
    # Shifted between the racks of a region: within the region only.
    b = at(weights={0: 0.5, 8: 1.5})
    moved = a != b
    assert moved.any() and set(a[moved] // region) == {0} == set(b[moved] // region)
    # Added to a shard: no rack wins a row but its own, no region but its own.
    b = at(weights={5: 3.0})
    moved = a != b
    assert set(b[moved] // region) == {0} and set(b[moved & (a // region == 0)] // per_rack) == {1}
    assert abs((b == 5).mean() - 3 / 26) < 0.01
    assert set(at(weights={5: 0.0})) == set(range(24)) - {5}


def test_slots_follow_an_order(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), (F.lit(9999) - F.col("id")).alias("_at"))
    got = shards.shard_documents(rows, 24, carry=("_at",), order=("_at",), stretch=(F.floor(F.col("_at") / 100),)).collect()
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r["shard"]].append((r["slot"], r["_at"]))
    assert len(by_shard) == 24
    for found in by_shard.values():
        found.sort()
        assert [s for s, _ in found] == list(range(len(found))) and [a for _, a in found] == sorted(a for _, a in found)
    tree = shards.shard_documents(rows, 13).first()
    assert (tree["law"], tree["grown_shard"]) == ("tree", None)


def test_shard_odd_rows(odd, empty, spark):
    got = shards.shard_documents(odd, 24).collect()
    assert len(got) == odd.count()
    assert len({r["shard"] for r in got if r["doc_id"] == 8}) == 1 and len({r["shard"] for r in got if r["doc_id"] is None}) == 1
    assert shards.shard_documents(empty, 24).count() == 0
    plan = explain_text(shards.shard_documents(odd, 24))
    assert "Python" not in plan and "Pandas" not in plan
    with pytest.raises(ValueError):
        shards.shard_documents(odd, 24, carry=("slot",))


def test_pipeline_stages_against_plain_ones(spark, docs):
    columns, rows = docs.columns, docs
    labels, items = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        rows = staged(stage(spark, rows, SF), f"test-{name}")
        results[name] = rows
        assert rows.columns[: len(columns)] == columns
        if name != "shard":
            assert rows.columns == columns
    ids = {n: sorted(r["doc_id"] for r in f.select("doc_id").collect()) for n, f in results.items()}
    scores = {r["doc_id"]: r["predicted"] for r in quality.score_quality(docs, labels).collect()}
    assert ids["quality"] == sorted(i for i, p in scores.items() if p)
    first = [(r["doc_id"], r["text"]) for r in results["quality"].collect()]
    groups, _ = plain_components(first, 5)
    assert ids["near_duplicates"] == sorted({groups[i] for i, _ in first})
    folded = [decontaminate.fold(r["text"]) for r in items.collect()]
    leaks = {r["doc_id"] for r in results["near_duplicates"].collect() if any(i in decontaminate.fold(r["text"] or "") for i in folded)}
    assert set(ids["decontaminate"]) <= set(ids["near_duplicates"]) - leaks
    assert len(ids["decontaminate"]) >= len(ids["near_duplicates"]) - len(leaks) - 2
    taken = {r["doc_id"]: len(r["copies"]) for r in mixing.mix(results["decontaminate"], whole=True).collect()}
    assert ids["mix"] == sorted(i for i, n in taken.items() for _ in range(n))
    assert ids["shard"] == ids["mix"]
    slots = defaultdict(list)
    for r in results["shard"].collect():
        slots[r["shard"]].append((r["slot"], r["doc_id"], r["text"]))
    assert all([s for s, _, _ in sorted(found)] == list(range(len(found))) for found in slots.values())
    # Slots follow the training order: each document's copies lie where the curriculum puts them.
    order = mixing.training_order(mixing.mix(results["decontaminate"], whole=True, carry=("text",))).collect()
    due = {}
    for r in order:
        due.setdefault(r["doc_id"], []).append(r["position"])
    for found in slots.values():
        seen, places = defaultdict(int), []
        for _, i, _ in sorted(found):
            places.append(sorted(due[i])[seen[i]])
            seen[i] += 1
        assert places == sorted(places)


def test_pipeline_on_odd_rows(spark, odd, empty, tmp_path, monkeypatch):
    """Columns that are named like results and internals go through, and every stage does what it says to odd rows."""
    names = ("_quality_score", "_row", "_bucket", "_stretch", "_file", "_at", "_document")
    odd = odd.select("*", *[F.lit(n).alias(n) for n in names])
    monkeypatch.setattr(quality, "REJECT_BELOW", -1.0)  # let all rows on, so that the later stages see them
    for n, frame in enumerate((odd, empty)):
        folder = tmp_path / str(n)
        frame.write.parquet(str(folder / "documents.parquet"))
        for t in ("labels", "benchmark"):
            spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(str(folder / f"{t}.parquet"))
        got = corpus_pipeline.run(spark, str(folder))
        assert [c for c in got.columns if c not in ("shard", "slot")] == [c for c in frame.columns if c not in ("shard", "slot")]
        rows = got.collect()
        if n:
            assert not rows
            continue
        by_id = defaultdict(list)
        for r in rows:
            by_id[r["doc_id"]].append(r)
            assert all(r[c] == c for c in names) and r["node"] == "clash"
        assert set(by_id) | {8} == {None, 1, 6, 7, 8, 9, 10}  # 2 is a copy of 1; 3, 4 and 5 have no words; the mix may pass 8 over
        assert {r["text"] for r in by_id[9]} == {"same id first text", "same id second text"}
        for i in (i for i in (None, 8) if i in by_id):  # rows repeated whole count once, however often the mix takes them
            assert len({r["text"] for r in by_id[i]}) == 1
        assert all(r["lang"] is None or r["lang"] in ("en", "de", "es") for r in rows)
        slots = defaultdict(list)
        for r in rows:
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(x) == list(range(len(x))) for x in slots.values())
        # A source's copies make its target, to within half of a document.
        assert all(len(copies) <= 3 * 2 for copies in by_id.values())


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))
