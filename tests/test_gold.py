import pytest
from pyspark.sql import functions as F

from wardstat import schemas as S
from wardstat.plans import gold as G

DAY = ["PROVNUM", "PROVNAME", "STATE", "WorkDate", *S.PBJ_NUMBERS]


def day(provnum="015009", name="Home", state="AL", date="20240401", **numbers):
    known = {"PROVNUM": provnum, "PROVNAME": name, "STATE": state, "WorkDate": date, **numbers}
    return tuple(None if known.get(c) is None else str(known[c]) for c in DAY)


def days(spark, *rows):
    return G.prepare_daily(spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in DAY)))


def staffing(spark, *rows):
    return G.staffing_metrics(G.monthly_rollup(days(spark, *rows)))


def provider(spark, *rows):
    schema = "PROVNUM string, PROVNAME string, STATE string, " + ", ".join(
        f"{c} double" for c in S.PROVIDER_NUMBERS.values())
    return spark.createDataFrame(list(rows), schema)


def test_month_of_one_facility(spark, either_mode):
    row = staffing(
        spark,
        day(date="20240401", MDScensus=50, Hrs_RN=8, Hrs_LPN=16, Hrs_CNA=40, Hrs_RN_emp=8,
            Hrs_LPN_emp=10, Hrs_LPN_ctr=6, Hrs_CNA_ctr=40),
        day(date="2024-04-30", MDScensus=52, Hrs_RN=10, Hrs_CNA="bad"),
    ).first().asDict()
    assert row == {
        "PROVNUM": "015009", "PROVNAME": "Home", "STATE": "AL", "YEAR": 2024, "MONTH": 4,
        "TOTAL_NURSE_HOURS": 74.0, "AVG_PATIENT_CENSUS": 51.0, "RN_HOURS": 18.0,
        "LPN_HOURS": 16.0, "CNA_HOURS": 40.0, "EMPLOYEE_HOURS": 18.0, "CONTRACT_HOURS": 46.0,
        "NURSE_TO_PATIENT_RATIO": 1.45, "EMPLOYEE_STAFF_PERCENT": 24.32,
        "CONTRACT_STAFF_PERCENT": 62.16}


def test_null_census_gives_ratio_zero(spark, either_mode):
    row = staffing(spark, day(Hrs_RN=40)).first()
    assert row.AVG_PATIENT_CENSUS is None and row.NURSE_TO_PATIENT_RATIO == 0


def test_all_hours_null(spark, either_mode):
    row = staffing(spark, day(MDScensus=5), day(MDScensus=6)).first()
    assert (row.RN_HOURS, row.LPN_HOURS, row.CNA_HOURS) == (None, None, None)
    assert (row.TOTAL_NURSE_HOURS, row.EMPLOYEE_STAFF_PERCENT, row.CONTRACT_STAFF_PERCENT) == (0, 0, 0)


def test_bad_dates_and_null_keys_stay(spark, either_mode):
    rows = staffing(spark, day(date="junk", Hrs_RN=1), day(state=None, Hrs_RN=2)).collect()
    assert {(r.STATE, r.YEAR, r.RN_HOURS) for r in rows} == {("AL", None, 1.0), (None, 2024, 2.0)}


def test_renamed_facility_is_two_lines(spark):
    assert staffing(spark, day(name="Old"), day(name="New")).count() == 2


def test_facility_attributes_from_their_own_table(spark):
    flat = days(spark, day(Hrs_RN=1, MDScensus=3), day(provnum="2", name="B", state="TX", Hrs_RN=4))
    keys = flat.select(*S.FACILITY_KEYS).distinct()
    bare = flat.drop("PROVNAME", "STATE")
    for build in (G.monthly_rollup, G.patient_volume):
        a, b = build(flat), build(bare, keys)
        assert a.columns == b.columns
        assert sorted(a.collect()) == sorted(b.collect())


def test_no_day_is_lost_or_doubled(spark):
    flat = days(spark, day(Hrs_RN=1, MDScensus=3), day(provnum="9", Hrs_RN=4), day(provnum=None, Hrs_RN=2))
    keys = spark.createDataFrame(
        [("015009", "Home", "AL"), ("015009", "Home II", "AL")], "PROVNUM string, PROVNAME string, STATE string")
    got = {(r.PROVNUM, r.PROVNAME, r.STATE, r.RN_HOURS)
           for r in G.monthly_rollup(flat.drop("PROVNAME", "STATE"), keys).collect()}
    assert got == {("015009", "Home", "AL", 1.0), ("9", None, None, 4.0), (None, None, None, 2.0)}


def test_monthly_hours_add_up_to_daily_hours(spark):
    rows = [day(provnum=str(i % 7), date=f"2024{4 + i % 3:02d}{1 + i % 28:02d}", Hrs_RN=i * 0.25)
            for i in range(200)]
    total = staffing(spark, *rows).agg(F.sum("TOTAL_NURSE_HOURS")).first()[0]
    assert total == sum(i * 0.25 for i in range(200))


def test_facility_mean_is_over_months_not_days(spark):
    table = staffing(
        spark, day(date="20240401", Hrs_RN=1, MDScensus=1), day(date="20240402", Hrs_RN=1, MDScensus=1),
        day(date="20240501", Hrs_RN=4, MDScensus=1))
    assert G.facility_mean_ratio(table).first().AVG_STAFFING_RATIO == 3.0


def test_facility_metrics(spark, either_mode):
    providers = provider(
        spark,
        ("1", "A", "AL", 0.0, 10.0, 1.0, 1.0, 1.0),
        ("2", "B", "AL", 100.0, None, 1.0, 1.0, 1.0),
        ("01A193", "C", "AL", 80.0, 60.0, 1.0, 1.0, 1.0),
        (None, "D", "AL", 80.0, 60.0, 1.0, 1.0, 1.0))
    ratios = spark.createDataFrame(
        [("1", 2.5), ("2", 2.0), (None, 4.0), ("9", 1.0)], "PROVNUM string, AVG_STAFFING_RATIO double")
    got = {r.PROVNUM: (r.OCCUPANCY_RATE, r.AVG_STAFFING_RATIO, r.STAFFING_PRESSURE_INDEX)
           for r in G.facility_metrics(providers, ratios).collect()}
    assert got == {"1": (0.0, 2.5, 4.0), "2": (None, 2.0, None), "01A193": (75.0, None, 0.0),
                   None: (75.0, None, 0.0)}


def test_quality_score(spark, either_mode):
    providers = provider(
        spark, ("1", "A", "AL", 1.0, 1.0, 4.0, None, 5.0), ("2", "B", "AL", 1.0, 1.0, None, None, None))
    got = {r.PROVNUM: r.FACILITY_QUALITY_SCORE for r in G.quality_metrics(providers).collect()}
    assert got == {"1": 4.5, "2": None}


def test_both_provider_tables_keep_the_same_row(spark):
    rows = [("1", name, "AL", beds, 10.0, rating, 1.0, 1.0)
            for name, beds, rating in (("B", 5.0, 1.0), ("A", 50.0, 5.0), ("A", 20.0, 3.0))]
    unique = G.unique_providers(provider(spark, *rows))
    ratios = spark.createDataFrame([], "PROVNUM string, AVG_STAFFING_RATIO double")
    facility = G.facility_metrics(unique, ratios).collect()
    quality = G.quality_metrics(unique).collect()
    assert len(facility) == len(quality) == 1
    assert (facility[0].PROVNAME, facility[0].CERTIFIED_BEDS, quality[0].OVERALL_RATING) == ("A", 20.0, 3.0)


def test_top_volume_ties_and_missing_census(spark):
    rows = [day(provnum=p, MDScensus=c) for p, c in (("9", 5), ("10", 5), ("3", 7), ("4", None))]
    volume = G.patient_volume(days(spark, *rows))
    assert [r.PROVNUM for r in G.top_patient_volume(volume, 3).collect()] == ["3", "10", "9"]
    assert [r.PROVNUM for r in G.top_patient_volume(volume).collect()] == ["3", "10", "9", "4"]


@pytest.mark.parametrize("headers", ["raw", "sanitised"])
def test_provider_model_from_either_header(spark, headers):
    from wardstat.operators.columns import sanitize_columns
    names = [*S.PROVIDER_TEXT, *S.PROVIDER_NUMBERS]
    raw = spark.createDataFrame([("015009", "Home", "AL", "80", "", "5", "x", "3")],
                                ", ".join(f"`{n}` string" for n in names))
    model = G.provider_model(raw if headers == "raw" else sanitize_columns(raw))
    assert tuple(model.first()) == ("015009", "Home", "AL", 80.0, None, 5.0, None, 3.0)
