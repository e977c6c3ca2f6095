"""Sums of any size, counts from footers, digests, sketches and top lists of groups."""

import math

import pytest
from pyspark.sql import functions as F

from settings import session_settings
from wardstat.functions.metrics import exact_mean, exact_sum
from wardstat.operators import profiling as P
from wardstat.operators.ranking import top_k_of_each
from wardstat.plans import serving as D


def figures(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    return rows.agg(exact_sum("v"), exact_mean("v")).first()


@pytest.mark.parametrize("values", [
    [9.0e12, 9.0e12], [1e13, 5.0], [-9.0e12] * 5 + [0.25], [9.2e12] * 2000, [0.01] * 3000, [None, 2.5], [-0.000001, 3.0], [1e30, 1.0]])
def test_totals_of_any_size(spark, values):
    total, mean = figures(spark, values)
    some = [v for v in values if v is not None]
    assert total == pytest.approx(math.fsum(some), rel=1e-15)
    assert mean == pytest.approx(math.fsum(some) / len(some), rel=1e-15)


def test_no_value_vanishes(spark):
    assert math.isnan(figures(spark, [math.nan, 2.0])[0]) and math.isnan(figures(spark, [math.nan, 2.0])[1])
    assert figures(spark, [math.inf, 2.0])[0] == math.inf
    assert tuple(figures(spark, [None, None])) == (None, None)


def test_a_total_does_not_depend_on_the_order(spark):
    values = [0.1 * i for i in range(5000)] + [8e12, -7e12]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    totals = {rows.repartition(n, "v").agg(exact_sum("v")).first()[0] for n in (1, 3, 7)}
    assert len(totals) == 1


def test_null_counts_from_footers(spark, tmp_path):
    rows = spark.sql("SELECT id, IF(id % 3 = 0, NULL, cast(id AS string)) AS `a.b`, IF(id = 4, NULL, array(id)) AS listed, "
                     "IF(id % 2 = 0, NULL, cast(id AS double)) AS x, cast(NULL AS date) AS d FROM range(1000)")
    path = str(tmp_path / "rows")
    rows.repartition(3).write.parquet(path)
    assert tuple(P.null_counts_of_files(spark, path).first()) == tuple(P.null_counts(rows).first())
    with session_settings(spark, {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}):
        plan = P.footer_counts(spark, path, ["id", "a.b", "x", "d"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(" in plan and "COUNT(`a.b`)" in plan.replace("COUNT(a.b)", "COUNT(`a.b`)")


def test_null_counts_of_files_without_statistics(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    table = pa.table({"a": [1, None, 3], "b": ["x", None, None]})
    pq.write_table(table, tmp_path / "plain.parquet", write_statistics=False)
    assert tuple(P.null_counts_of_files(spark, str(tmp_path)).first()) == (1, 2)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_duplicates_by_digest(spark):
    rows = [(1, "a", None), (1, "a", None), (1, None, "a"), (2, "b", "b"), (2, "b", "b"), (2, "b", "b"), (3, "c", None), (None, None, None)]
    frame = spark.createDataFrame(rows, "_row int, x string, y string").repartition(3)
    got = {tuple(r) for r in P.duplicate_rows_by_digest(frame).collect()}
    assert got == {tuple(r) for r in P.duplicate_rows(frame).collect()} == {(1, "a", None, 2), (2, "b", "b", 3)}
    maps = spark.sql("SELECT map(1, id % 2) AS m FROM range(3)")
    assert [tuple(r) for r in P.duplicate_rows_by_digest(maps).collect()] == [({1: 0}, 2)]


def test_digests_are_what_moves(spark):
    """The first shuffle of the plan carries two hashes, not the texts."""
    wide = spark.range(100).select(F.repeat(F.lit("text"), 500).alias("t"), "id")
    with session_settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        plan = P.duplicate_rows_by_digest(wide)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_row" in plan


def test_top_lists_of_all_groups(spark):
    rows = [("TX", f"p{i}", float(i % 7)) for i in range(50)] + [("AL", "q", 1.0), ("AL", "r", None), (None, "s", 9.0)]
    frame = spark.createDataFrame(rows, "STATE string, PROVNUM string, m double").repartition(4)
    got = sorted(map(tuple, top_k_of_each(frame, "m", "STATE", 3, ties=["PROVNUM"]).collect()))
    assert got == [("AL", "q", 1.0, 1), ("TX", "p13", 6.0, 1), ("TX", "p20", 6.0, 2), ("TX", "p27", 6.0, 3)]
    plan = top_k_of_each(frame, "m", "STATE", 3, ties=["PROVNUM"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_sketches_unite(spark):
    rows = spark.range(40000).selectExpr("concat('S', id % 4) AS STATE", "cast(id % 15000 AS string) AS PROVNUM")
    sketches = D.facility_sketches(rows)
    assert sketches.count() == 4
    assert D.estimated_facilities(sketches).first()[0] == pytest.approx(15000, rel=0.05)
    assert D.estimated_facilities(D.in_state(sketches, "nowhere")).first()[0] == 0
