import pytest
from pyspark.sql import functions as F

from wardstat.operators import columns as C
from wardstat.operators import profiling as P
from wardstat.operators.ranking import top_k
from wardstat.operators.reshape import aggregates_as_rows, to_long


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_drop_if_present_ignores_case_and_absent_names(spark):
    df = spark.sql("SELECT 1 AS `Special Focus Status`, 2 AS b")
    assert C.drop_if_present(df, ["special focus status", "nowhere"]).columns == ["b"]


def test_resolve_raw_sanitised_and_missing(spark):
    df = spark.sql("SELECT 1 AS Provider_Name, 2 AS `State`")
    assert C.resolve(df, "Provider Name") == "Provider_Name"
    assert C.resolve(df, "STATE") == "State"
    with pytest.raises(ValueError, match="available"):
        C.resolve(df, "Overall Rating")


def test_select_renamed_keeps_leading_zeros(spark, either_mode):
    df = spark.createDataFrame([("015009", "12"), ("01A193", "x")], "`Id (CCN)` string, beds string")
    out = C.select_renamed(df, text={"Id (CCN)": "ID"}, numbers={"beds": "BEDS"})
    assert rows(out) == [("015009", 12.0), ("01A193", None)]


def test_apply_types_passes_other_columns_through(spark, either_mode):
    df = spark.createDataFrame([("1.5", "007", "20240401")], "`x y` string, id string, d string")
    out = C.apply_types(df, numbers=["x y", "absent"], dates=["d"])
    assert out.dtypes == [("x y", "double"), ("id", "string"), ("d", "date")]


def test_apply_types_finds_sanitised_headers(spark):
    df = spark.createDataFrame([("1.5",)], "Overall_Rating string")
    assert C.apply_types(df, numbers=["Overall Rating"]).dtypes == [("Overall_Rating", "double")]


def test_coerce_numeric_skips_absent_columns(spark, either_mode):
    df = spark.createDataFrame([("1,000", "a"), (" 5 ", "b")], "n string, t string")
    assert rows(C.coerce_numeric(df, ["n", "gone"])) == [(5.0, "b"), (None, "a")]


def test_require_columns(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS b")
    assert C.require_columns(df, ["a"]) is df
    with pytest.raises(ValueError, match=r"\['c'\].*\['a', 'b'\]"):
        C.require_columns(df, ["a", "c"])


def test_schema_report_and_profile(spark):
    df = spark.sql("SELECT 1 AS `a.b`, cast(NULL AS string) AS `c d`")
    assert rows(C.schema_report(df)) == [(1, "a.b", "int"), (2, "c d", "string")]
    assert rows(C.column_profile(df)) == [(1, "a.b", "int", 0), (2, "c d", "string", 1)]


def test_null_summary(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "`a.b` int, `c (d)` string")
    summary = P.null_summary(df)
    assert summary.dtypes == [("column_name", "string"), ("null_count", "bigint")]
    assert [tuple(r) for r in P.most_nulls_first(summary).collect()] == [("c (d)", 2), ("a.b", 1)]
    assert rows(P.nulls_by_column(summary.union(summary))) == [("a.b", 2), ("c (d)", 4)]
    assert rows(P.row_count(summary)) == [(2,)]


def test_null_summary_of_nothing_is_zero(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert rows(P.null_summary(df)) == [("a", 0), ("b", 0)]


def test_duplicate_rows_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, `b c` string")
    assert rows(P.duplicate_rows(df)) == [(1, None, 2)]
    assert rows(P.drop_exact_duplicates(df)) == [(1, None), (2, "x")]


def test_duplicate_rows_refuses_a_taken_name(spark):
    df = spark.sql("SELECT 1 AS count")
    assert P.duplicate_rows(df).columns == ["count", "dup_count"]
    with pytest.raises(ValueError, match="Count"):
        P.duplicate_rows(df, "Count")


def test_first_row_per_key(spark):
    data = [("b", "n2", 1.0), ("b", "n1", 9.0), ("b", "n1", None), ("a", None, 5.0), ("a", "z", 1.0),
            (None, "q", 2.0), (None, "p", 3.0)]
    df = spark.createDataFrame(data, "k string, n string, v double")
    expected = [("a", None, 5.0), ("b", "n1", None), (None, "p", 3.0)]
    for parts in (1, 3, 7):
        assert rows(P.first_row_per_key(df.repartition(parts), ["k"])) == sorted(expected, key=repr)


def test_first_row_per_key_keeps_column_order(spark):
    df = spark.sql("SELECT 1 AS `a.b`, 'x' AS k, 2 AS c")
    out = P.first_row_per_key(df, ["k"])
    assert out.columns == ["a.b", "k", "c"] and rows(out) == [(1, "x", 2)]
    keys_only = df.select("k").union(df.select("k"))
    assert rows(P.first_row_per_key(keys_only, ["k"])) == [("x",)]


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    hot = spark.range(0, 60000, numPartitions=6).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id AS string) END AS k", "id AS v")
    plan = P.first_row_per_key(hot, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange")
    assert P.first_row_per_key(hot, ["k"]).count() == 40001


def test_top_k_breaks_ties_by_key_and_drops_nulls(spark):
    data = [("10", 5.0), ("9", 5.0), ("1", None), ("2", 7.0)]
    df = spark.createDataFrame(data, "PROVNUM string, m double")
    assert [r[0] for r in top_k(df, "m", 2, ties=["PROVNUM"]).collect()] == ["2", "10"]
    assert [r[0] for r in top_k(df, "m", 9, ["PROVNUM"]).collect()] == ["2", "10", "9"]
    kept = top_k(df, "m", 9, ["PROVNUM"], keep_null=True)
    assert [r[0] for r in kept.collect()] == ["2", "10", "9", "1"]


def test_reshape(spark):
    df = spark.createDataFrame([("x", 1.0, 2.0), ("y", 3.0, None)], "s string, a double, b double")
    measures = {"All of a": F.sum("a"), "b": F.sum("b")}
    assert rows(aggregates_as_rows(df, measures, "what", "n")) == [("All of a", 4.0), ("b", 2.0)]
    assert rows(to_long(df, "s", ["a", "b"])) == [
        ("x", "a", 1.0), ("x", "b", 2.0), ("y", "a", 3.0), ("y", "b", None)]
