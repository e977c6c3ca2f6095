import pytest

from wardstat import schemas as S
from wardstat.plans import serving as D

STAFFING = "PROVNUM string, PROVNAME string, STATE string, YEAR int, MONTH int, " + ", ".join(
    f"{c} double" for c in S.GOLD_NUMBERS["staffing_metrics"])
FACILITY = "PROVNUM string, PROVNAME string, STATE string, " + ", ".join(
    f"{c} double" for c in S.GOLD_NUMBERS["facility_metrics"])
QUALITY = "PROVNUM string, PROVNAME string, STATE string, " + ", ".join(
    f"{c} double" for c in S.GOLD_NUMBERS["quality_metrics"])
VOLUME = "PROVNUM string, PROVNAME string, STATE string, TOTAL_PATIENT_DAYS double"


def staffing(spark, *rows):
    """Rows of (provnum, state, month, total hours, rn hours, ratio)."""
    return spark.createDataFrame(
        [(p, f"N{p}", s, 2024, m, t, 1.0, rn, None, None, 2.0, 1.0, ratio, 0.0, 0.0)
         for p, s, m, t, rn, ratio in rows], STAFFING)


def facility(spark, *rows):
    """Rows of (provnum, state, occupancy, pressure)."""
    return spark.createDataFrame(
        [(p, f"N{p}", s, 10.0, 5.0, 3.0, 3.0, 3.0, occupancy, 1.0, pressure)
         for p, s, occupancy, pressure in rows], FACILITY)


def quality(spark, *rows):
    """Rows of (provnum, state, overall, health, score)."""
    return spark.createDataFrame(
        [(p, f"N{p}", s, overall, health, None, score) for p, s, overall, health, score in rows],
        QUALITY)


@pytest.fixture(scope="module")
def board(spark):
    return D.Dashboard.over({
        "staffing_metrics": staffing(
            spark, ("1", "AL", 4, 10.0, 4.0, 2.0), ("1", "AL", 5, 20.0, None, 3.0),
            ("2", "TX", 4, 5.0, None, 0.0), ("3", None, 4, 7.0, 7.0, 9.0)),
        "facility_metrics": facility(
            spark, ("1", "AL", 50.0, 4.0), ("2", "TX", None, 0.0), ("3", None, 80.0, None),
            (None, "TX", 20.0, 9.0)),
        "quality_metrics": quality(
            spark, ("1", "AL", 5.0, 4.0, 4.5), ("2", "TX", None, None, None), ("3", None, 1.0, 1.0, 1.0)),
        "top_patient_volume": spark.createDataFrame(
            [("1", "N1", "AL", 90.0), ("2", "N2", "TX", 80.0), ("3", "N3", None, None)], VOLUME),
    })


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_kpi_cards(board):
    assert rows(board.kpi_cards()) == [(3, 42.0, 50.0, 2.75)]
    assert rows(board.for_state("TX").kpi_cards()) == [(1, 5.0, 20.0, None)]
    assert rows(board.for_state("nowhere").kpi_cards()) == [(0, 0.0, None, None)]


def test_all_states_is_no_filter(board):
    assert board.for_state(D.ALL_STATES).facility.count() == 4
    assert board.for_state(None).facility.count() == 4
    no_state = board.staffing.drop("STATE")
    assert D.in_state(no_state, "TX") is no_state


def test_states_are_sorted_without_null(board):
    assert rows(board.states()) == [("AL",), ("TX",)]


def test_hours(board):
    assert rows(board.hours_by_staff_type()) == [("RN", 11.0), ("LPN", 0.0), ("CNA", 0.0)]
    assert rows(board.employee_vs_contract()) == [("Employee Hours", 8.0), ("Contract Hours", 4.0)]


def test_ratings(board):
    assert rows(board.average_ratings()) == [
        ("Overall Rating", 3.0), ("Health Rating", 2.5), ("Staffing Rating", None)]


def test_top_lists(board):
    def keys(df):
        return [r.PROVNUM for r in df.collect()]
    assert keys(board.top_occupancy()) == ["3", "1", None]
    assert keys(board.top_occupancy(1)) == ["3"]
    assert keys(board.top_pressure()) == [None, "1", "2"]
    assert keys(board.top_quality()) == ["1", "3"]
    assert keys(board.top_volume()) == ["1", "2"]
    assert keys(board.for_state("TX").top_volume()) == ["2"]


def test_mean_ratio_drops_null_keys_and_keeps_zeros(board):
    assert rows(board.top_nurse_ratio()) == [("1", "N1", "AL", 2.5), ("2", "N2", "TX", 0.0)]


def test_heatmaps_drop_the_null_state(board):
    assert rows(board.quality_heatmap()) == [("AL", 4.5, 5.0, 4.0, None), ("TX", None, None, None, None)]
    assert rows(board.staffing_heatmap()) == [
        ("AL", 30.0, 4.0, 0.0, 0.0, 4.0, 2.0), ("TX", 5.0, 0.0, 0.0, 0.0, 2.0, 1.0)]
    assert board.quality_heatmap_long().count() == 8
    assert board.staffing_heatmap_long().count() == 12


def test_text_tables_are_coerced(spark, board):
    def as_text(df):
        return df.selectExpr(*[f"cast({c} AS string) AS `{c.lower().replace('_', ' ')}`"
                               for c in df.columns])
    text = D.Dashboard.over({
        "staffing_metrics": as_text(board.staffing), "facility_metrics": as_text(board.facility),
        "quality_metrics": as_text(board.quality), "top_patient_volume": as_text(board.volume)})
    assert rows(text.kpi_cards()) == rows(board.kpi_cards())
    assert rows(text.top_pressure()) == rows(board.top_pressure())


def test_a_facility_table_without_its_keys_is_refused(spark, board):
    with pytest.raises(ValueError, match="PROVNAME"):
        D.Dashboard.over({
            "staffing_metrics": board.staffing, "facility_metrics": board.facility.drop("PROVNAME"),
            "quality_metrics": board.quality, "top_patient_volume": board.volume})
