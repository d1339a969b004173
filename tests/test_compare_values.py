"""Comparison by value: type, key and row findings counted over both tables."""

from tidemark.operators.compare import TablePair, compare_values, key_findings, type_findings, value_findings


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_values_that_do_not_fit_the_other_type(spark):
    src = spark.createDataFrame([(1, "7", None, [1], "x"), (2, "abc", 2.5, None, "y"), (None, None, 1e300, [2], None)],
                                "a long, b string, c double, d array<int>, gone string")
    tgt = spark.createDataFrame([("1", 5, 3, "q"), ("x", None, 4, None), (None, 6, None, "r")], "a string, b int, c int, d string")
    got = rows(type_findings("p", src, tgt), "kind", "column_name", "src_values", "src_unfit", "tgt_values", "tgt_unfit")
    assert got == [("missing_in_target", "gone", 2, 2, None, None), ("type_mismatch", "a", 2, 0, 2, 1),
                   ("type_mismatch", "b", 2, 1, 2, 0), ("type_mismatch", "c", 2, 1, 2, 0), ("type_mismatch", "d", 2, 0, 2, 2)]
    assert type_findings("p", src, src).count() == 0
    none = type_findings("p", src.limit(0), tgt.limit(0))
    assert {r["src_values"] for r in none.collect()} == {0}


def test_key_findings(spark):
    src = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c"), (4, "d")] + [(9, "hot")] * 500, "k long, ID string")
    tgt = spark.createDataFrame([(1, "a"), (None, "z"), (3, "c"), (3, "c"), (8, "h")], "K long, S_ID string")
    got = rows(key_findings("p", src, tgt, ["k", "ID"], ["k", "ID"]), "kind", "n")
    assert got == [("source_key_missing", 2), ("source_key_null", 1), ("source_key_repeats", 2), ("target_key_null", 1), ("target_key_repeats", 1)]
    assert ("key_mismatch", None) in rows(key_findings("p", src, tgt, ["k", "ID"], ["k"]), "kind", "n")
    assert key_findings("p", src.limit(0), tgt.limit(0), ["k"], ["k"]).count() == 0
    few = src.where("k in (3, 4)").limit(1)
    assert rows(key_findings("p", few, few, ["k"], ["k"]), "kind", "n") == []


def test_value_findings_and_pairs_that_fail(spark):
    src = spark.createDataFrame([(1, "A", None, 1.0), (2, "b", "x", 2.0), (None, "n", "n", 0.0)], "k long, u string, v string, w double")
    tgt = spark.createDataFrame([(1, "a", None, 1.0), (2, "b", None, 3.0), (None, "m", "m", 9.0), (5, "e", "e", 5.0)],
                                "k long, u string, v string, w double")
    assert rows(value_findings("p", src, tgt, ["k"]), "column_name", "n") == [("u", 1), ("v", 1), ("w", 1)]
    assert rows(value_findings("p", src, tgt, ["k"], "UNICODE_CI"), "column_name", "n") == [("v", 1), ("w", 1)]
    assert value_findings("p", src, src, ["k"]).count() == 0 and value_findings("p", src.select("k"), tgt, ["k"]).count() == 0
    pairs = [TablePair("good", lambda: src, lambda: tgt, ["k"], ["k"]), TablePair("same", lambda: src.where("k = 1"), lambda: src.where("k = 1"), ["k"], ["k"]),
             TablePair("bad", lambda: src, lambda: spark.read.parquet("/nonexistent/x.parquet"), ["k"], ["k"]),
             TablePair("empty", lambda: src.limit(0), lambda: tgt, ["k"], ["k"])]
    got = rows(compare_values(spark, pairs), "pair", "kind", "column_name")
    assert {p for p, _, _ in got} == {"good", "bad", "empty"}
    assert ("bad", "error", None) in got and ("empty", "empty_table", None) in got and ("good", "value_diff", "w") in got
