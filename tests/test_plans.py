"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F
from settings import session_settings

from verification import views as V
from verification.catalogue import QUERIES
from wardstat.plans import gold as G
from wardstat.plans import serving as D

SF_DIR = "/root/testdata/sf0.001"
DIRECT = [
    "staffing_metrics", "staffing_metrics_flat", "facility_avg_ratio", "facility_metrics",
    "quality_metrics", "top_patient_volume", "kpi_cards", "kpi_cards_state", "top_occupancy",
    "top_nurse_ratio", "quality_heatmap", "staffing_heatmap", "null_summary", "duplicate_rows",
    "dedup_by_key", "state_list", "hours_by_staff_type",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large_tables(spark):
    """Plan as if no side were small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", DIRECT)
def test_no_cross_joins_windows_or_python(spark, large_tables, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window", "Python", "Pandas"):
        assert operator not in text


def test_days_are_reduced_before_any_shuffle(spark, large_tables):
    text = plan(V.staffing(spark, SF_DIR))
    days = next(line for line in text.split("\n") if "lineitem.parquet" in line)
    above = text.split(days)[0].split("\n")
    depth = [line for line in above if "Exchange" in line or "partial_try_sum" in line]
    assert "partial_try_sum" in depth[-1]


def test_flat_days_are_reduced_before_the_second_shuffle(spark, large_tables):
    """A join on PROVNUM would leave a hot facility in one task."""
    text = plan(QUERIES["staffing_metrics_flat"](spark, SF_DIR)).split("partial_try_sum")[0]
    assert "Exchange hashpartitioning(PROVNUM" in text


def test_a_hot_facility_is_split_in_the_flat_join(spark, large_tables, tmp_path):
    """A third of all days in one facility: adaptive execution splits its join."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    sf_dir = "/root/testdata/sf0.01"
    for name in ("supplier", "nation"):
        V.table(spark, sf_dir, name).write.parquet(str(tmp_path / f"{name}.parquet"))
    hot = V.table(spark, sf_dir, "lineitem").withColumn("l_suppkey", F.expr(
        "CASE WHEN l_orderkey % 3 = 0 THEN 7L ELSE l_suppkey END"))
    hot.repartition(6).write.parquet(str(tmp_path / "lineitem.parquet"))
    with session_settings(spark, settings):
        flat = QUERIES["staffing_metrics_flat"](spark, str(tmp_path))
        rows = flat.collect()
        assert "skew=true" in plan(flat)
    others = QUERIES["staffing_metrics"](spark, str(tmp_path)).collect()
    assert sorted(rows, key=repr) == sorted(others, key=repr)


def test_scan_reads_only_what_the_figure_needs(spark):
    text = plan(D.staffing_heatmap(V.staffing(spark, SF_DIR)).select("STATE", "RN_HOURS"))
    days = next(line for line in text.split("\n") if "lineitem.parquet" in line)
    schema = days.split("ReadSchema")[1]
    assert "l_extendedprice" not in schema and "l_tax" not in schema


def test_occupancy_ranks_before_it_joins(spark, large_tables):
    """The query itself: the days meet no more than ten facilities, before they are reduced."""
    frame = QUERIES["top_occupancy"](spark, SF_DIR)
    text = plan(frame)
    days = next(line for line in text.split("\n") if "lineitem.parquet" in line)
    assert "BroadcastHashJoin" in text.split(days)[0].split("partial_try_sum")[-1]
    assert "TakeOrderedAndProject" in text.split(days)[1]
    whole = G.top_k(V.facility(spark, SF_DIR), "OCCUPANCY_RATE", 10)
    assert frame.collect() == whole.select(frame.columns).collect()


def test_no_job_runs_while_a_state_is_planned(spark):
    tracker = spark.sparkContext.statusTracker()
    V.staffing(spark, SF_DIR, "NATION_7")  # reads the schemas
    spark.sparkContext.setJobGroup("planning", "planning")
    V.staffing(spark, SF_DIR, "NATION_7")
    assert not tracker.getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_top_k_is_no_full_sort(spark):
    for name in ("top_patient_volume", "top_occupancy", "top_nurse_ratio"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF_DIR))


def test_state_filter_reaches_the_facilities(spark):
    text = plan(D.in_state(
        G.monthly_rollup(G.prepare_daily(V.pbj(spark, SF_DIR))), "NATION_7"))
    assert "EqualTo(n_name,NATION_7)" in text


def test_facility_join_needs_one_shuffle_of_providers(spark, large_tables):
    """The deduplicated providers are already placed for the join."""
    providers = G.unique_providers(V.provider_rows(spark, SF_DIR))
    ratios = G.facility_mean_ratio(V.staffing(spark, SF_DIR))
    text = plan(G.facility_metrics(providers, ratios))
    left = text.split("LeftOuter")[1].split("\n")[1:4]
    assert not any("Exchange" in line for line in left)


def test_null_counts_are_one_pass(spark):
    text = plan(QUERIES["null_summary_provider"](spark, SF_DIR))
    assert text.count("supplier.parquet") == 1
