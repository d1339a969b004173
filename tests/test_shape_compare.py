import pytest
from pyspark.sql import types as T

from tidemark.operators.compare import TablePair, compare_tables, empty_table_check, key_diffs, type_diffs
from tidemark.operators.shape import exclude_columns, rename_reserved
from tidemark.spec import SpecError


def test_reserved_columns_prefixed(spark):
    df = spark.createDataFrame([(1, 2, 3)], "ID int, ACTIVE_FLAG int, x int")
    assert rename_reserved(df).columns == ["S_ID", "S_ACTIVE_FLAG", "x"]


def test_exclude_case_insensitive_and_unknown(spark):
    df = spark.createDataFrame([(1, 2)], "a int, B int")
    assert exclude_columns(df, ["b"]).columns == ["a"]
    with pytest.raises(SpecError):
        exclude_columns(df, ["zz"])


def test_type_diffs():
    s = T.StructType([T.StructField("a", T.LongType()), T.StructField("d", T.DecimalType(10, 2)),
                      T.StructField("c", T.StringType()), T.StructField("ID", T.IntegerType())])
    t = T.StructType([T.StructField("A", T.StringType()), T.StructField("d", T.DecimalType(12, 4)),
                      T.StructField("S_ID", T.IntegerType()), T.StructField("ID", T.LongType())])
    found = {(f.kind, f.column_name) for f in type_diffs("p", s, t)}
    assert found == {("type_mismatch", "a"), ("missing_in_target", "c")}


def test_key_diffs_one_direction():
    assert key_diffs("p", ["a", "b"], ["B", "A", "c"]) == []
    assert [f.kind for f in key_diffs("p", ["a", "b"], ["a"])] == ["key_mismatch"]


def test_empty_tables_and_failing_pair(spark):
    full = spark.range(3).withColumnRenamed("id", "k")
    empty = spark.range(0).withColumnRenamed("id", "k")
    assert len(empty_table_check("p", empty, "t")) == 1 and empty_table_check("p", full, "t") == []
    pairs = [TablePair("ok", lambda: full, lambda: full, ["k"], ["k"]),
             TablePair("bad", lambda: full, lambda: spark.read.parquet("/nonexistent/x.parquet"), ["k"], ["k"]),
             TablePair("empty", lambda: empty, lambda: empty, ["k"], ["k"])]
    rows = {(r.pair, r.kind) for r in compare_tables(spark, pairs).collect()}
    assert rows == {("bad", "error"), ("empty", "empty_table")}


def test_pairs_from_specs(spark):
    import uuid
    from tidemark import fixtures as fx
    from tidemark.operators.compare import pairs_from_specs
    from tidemark.session import fresh_path
    from tidemark.spec import TableRef
    name = f"tm_cmp_{uuid.uuid4().hex[:8]}"
    fx.target_t(spark, "/root/testdata/sf0.001").drop("o_orderpriority") \
        .write.format("parquet").option("path", fresh_path(spark, "cmp")).saveAsTable(name)
    ok = fx.orders_spec(source=TableRef(path="/root/testdata/sf0.001/orders.parquet"), target=TableRef(name=name))
    bad = fx.orders_spec(name="BAD", source=TableRef(path="/root/testdata/sf0.001/orders.parquet"),
                         target=TableRef(name="tm_no_such_table"))
    rows = {(r.pair, r.kind, r.column_name) for r in compare_tables(spark, pairs_from_specs(spark, [ok, bad])).collect()}
    assert rows == {("MERGE_ORDERS", "missing_in_target", "o_orderpriority"), ("BAD", "error", None)}
