"""Delivered files to gold and served figures, on a handful of rows."""

import pytest

from wardstat import schemas as S
from wardstat.operators.columns import require_columns
from wardstat.plans import medallion as M
from wardstat.plans.serving import Dashboard
from wardstat.sources.files import read_gold
from wardstat.sources.sinks import write_dataset

PBJ_FILE = """PROVNUM,PROVNAME,CITY,STATE,WorkDate,MDScensus,Hrs_RN,Hrs_RN_emp,Hrs_RN_ctr,Hrs_LPN,\
Hrs_LPN_emp,Hrs_LPN_ctr,Hrs_CNA,Hrs_CNA_emp,Hrs_CNA_ctr
015009,"Maple, Inc",Rome,AL,20240401,50,10,10,0,20,15,5,70,70,0
015009,"Maple, Inc",Rome,AL,20240402,50,10,10,0,20,15,5,70,70,0
015009,"Maple, Inc",Rome,AL,20240501,40,8,8,,,,,32,,32
01A193,Oak,Waco,TX,20240401,,4,4,0,,,,n/a,,
"""
PROVIDER_FILE = """CMS Certification Number (CCN),Provider Name,State,Number of Certified Beds,\
Average Number of Residents per Day,Average Number of Residents per Day Footnote,Overall Rating,\
Overall Rating Footnote,Health Inspection Rating,Staffing Rating,Special Focus Status,Legal Name
015009,"Maple, Inc",AL,80,60.0,,5,,4,4,,M
015009,"Maple, Inc",AL,90,60.0,,5,,4,4,,M
01A193,Oak,TX,0,20.5,9,,18,,,SFF,O
01B000,Elm,TX,50,25,,2,,3,,,E
"""


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    raw = base / "raw"
    raw.mkdir()
    files = {S.PBJ: PBJ_FILE, S.PROVIDER: PROVIDER_FILE,
             S.STATE_AVERAGES: "State or Nation,QM Rating Footnote,Score (mean)\nAL,,3.5\n",
             S.SURVEY_DATES: "CMS Certification Number (CCN),Survey Date\n015009,2023-01-05\n"}
    for name, text in files.items():
        (raw / f"{name}.csv").write_text(text)
    M.run_all(spark, str(raw), str(base))
    return str(base)


@pytest.fixture(scope="module")
def gold(spark, lake):
    return {name: read_gold(spark, f"{lake}/gold", name) for name in S.GOLD_TABLES}


def test_silver_drops_and_types(spark, lake):
    provider = spark.read.parquet(f"{lake}/silver/{S.PROVIDER}")
    assert provider.columns == [
        "CMS Certification Number (CCN)", "Provider Name", "State", "Number of Certified Beds",
        "Average Number of Residents per Day", "Overall Rating", "Health Inspection Rating",
        "Staffing Rating", "Legal Name"]
    assert dict(provider.dtypes)["Overall Rating"] == "double"
    pbj = spark.read.parquet(f"{lake}/silver/{S.PBJ}")
    assert pbj.columns == PBJ_FILE.split("\n")[0].split(",")
    assert dict(pbj.dtypes)["WorkDate"] == "date"
    averages = spark.read.parquet(f"{lake}/silver/{S.STATE_AVERAGES}")
    assert averages.columns == ["State or Nation", "Score (mean)"]


def test_staffing(gold):
    got = {(r.PROVNUM, r.YEAR, r.MONTH): r for r in gold["staffing_metrics"].collect()}
    april = got["015009", 2024, 4]
    assert (april.TOTAL_NURSE_HOURS, april.NURSE_TO_PATIENT_RATIO) == (200.0, 4.0)
    assert (april.EMPLOYEE_STAFF_PERCENT, april.CONTRACT_STAFF_PERCENT) == (95.0, 5.0)
    oak = got["01A193", 2024, 4]
    assert (oak.CNA_HOURS, oak.NURSE_TO_PATIENT_RATIO, oak.STATE) == (None, 0.0, "TX")
    assert len(got) == 3


def test_facility(gold):
    got = {r.PROVNUM: r for r in gold["facility_metrics"].collect()}
    assert set(got) == {"015009", "01A193", "01B000"}
    maple = got["015009"]
    assert (maple.CERTIFIED_BEDS, maple.OCCUPANCY_RATE) == (80.0, 75.0)
    assert (maple.AVG_STAFFING_RATIO, maple.STAFFING_PRESSURE_INDEX) == (2.5, 24.0)
    assert (got["01A193"].OCCUPANCY_RATE, got["01A193"].STAFFING_PRESSURE_INDEX) == (0.0, 0.0)
    assert (got["01B000"].AVG_STAFFING_RATIO, got["01B000"].STAFFING_PRESSURE_INDEX) == (None, 0.0)


def test_quality_and_volume(gold):
    scores = {r.PROVNUM: r.FACILITY_QUALITY_SCORE for r in gold["quality_metrics"].collect()}
    assert scores == {"015009": 4.33, "01A193": None, "01B000": 2.5}
    days = [(r.PROVNUM, r.TOTAL_PATIENT_DAYS)
            for r in gold["top_patient_volume"].orderBy("PROVNUM").collect()]
    assert days == [("015009", 140.0), ("01A193", None)]


def test_served_figures(gold):
    board = Dashboard.over(gold)
    assert tuple(board.kpi_cards().first()) == pytest.approx((3, 244.0, 125 / 3, 3.415))
    assert [r.STATE for r in board.states().collect()] == ["AL", "TX"]
    assert board.for_state("TX").kpi_cards().first().TOTAL_NURSE_HOURS == 4.0


def test_a_second_run_replaces_the_first(spark, lake, gold):
    before = {name: table.count() for name, table in gold.items()}
    M.run_gold(spark, f"{lake}/silver", f"{lake}/gold")
    after = {n: read_gold(spark, f"{lake}/gold", n).count() for n in S.GOLD_TABLES}
    assert after == before


def test_one_month_leaves_the_others_alone(spark, lake, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    pbj = spark.read.parquet(f"{lake}/silver/{S.PBJ}")
    april = pbj.where("WorkDate < '2024-05-01'")
    april.write.parquet(f"{silver}/{S.PBJ}")
    spark.read.parquet(f"{lake}/silver/{S.PROVIDER}").write.parquet(f"{silver}/{S.PROVIDER}")
    M.run_gold(spark, silver, gold)

    def files():
        found = (tmp_path / "gold" / "staffing_metrics").rglob("*.parquet")
        return {str(p): p.stat().st_mtime_ns for p in found if "MONTH=4" in str(p)}

    before = files()
    pbj.where("WorkDate >= '2024-05-01'").write.mode("append").parquet(f"{silver}/{S.PBJ}")
    M.run_gold(spark, silver, gold, months=[(2024, 5)])
    assert before and files() == before
    for name in S.GOLD_TABLES:
        def table(where):
            return sorted(map(tuple, read_gold(spark, where, name).collect()), key=repr)
        assert table(gold) == table(f"{lake}/gold")


def _nodes(node):
    """The executed plan's nodes, those of its stages too."""
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        return _nodes(node.executedPlan())
    below = [node.plan()] if "QueryStage" in name else [node.children().apply(i) for i in range(node.children().size())]
    return [node, *(n for b in below for n in _nodes(b))]


def test_days_in_any_order_send_one_row_for_a_facility_and_month(spark, lake, tmp_path, monkeypatch):
    """Each task that sums days has whole months of few facilities, not a bit of all of them."""
    pbj = spark.read.parquet(f"{lake}/silver/{S.PBJ}").where("PROVNUM = '015009' and WorkDate = '2024-04-01'")
    days = pbj.drop("PROVNUM", "WorkDate").crossJoin(spark.range(960).selectExpr(
        "cast(id % 40 as string) as PROVNUM", "date_add(date'2024-04-01', cast(id / 40 as int)) as WorkDate"))
    days.select(pbj.columns).repartition(8).write.parquet(f"{tmp_path}/silver/{S.PBJ}")
    spark.read.parquet(f"{lake}/silver/{S.PROVIDER}").write.parquet(f"{tmp_path}/silver/{S.PROVIDER}")
    written = {}

    def noted(df, path, *args, **options):
        written[path] = df
        return write_dataset(df, path, *args, **options)

    monkeypatch.setattr(M, "write_dataset", noted)
    M.run_gold(spark, f"{tmp_path}/silver", f"{tmp_path}/gold")
    rollup = written[f"{tmp_path}/gold/{M.ROLLUP}"]
    assert [tuple(r) for r in rollup.select("AVG_PATIENT_CENSUS", "CENSUS_DAYS").collect()] == [(50, 1200)] * 40
    rollup.collect()
    sums = [n for n in _nodes(rollup._jdf.queryExecution().executedPlan()) if n.nodeName() == "HashAggregate"]
    assert [n.metrics().apply("numOutputRows").value() for n in sums] == [40, 40]


def test_missing_staffing_columns_are_named(spark, lake, tmp_path):
    pbj = spark.read.parquet(f"{lake}/silver/{S.PBJ}").drop("Hrs_RN")
    with pytest.raises(ValueError, match="Hrs_RN"):
        require_columns(pbj, S.PBJ_NUMBERS)
    pbj.write.parquet(str(tmp_path / S.PBJ))
    with pytest.raises(ValueError, match="missing columns"):
        M.run_gold(spark, str(tmp_path), str(tmp_path / "gold"))
