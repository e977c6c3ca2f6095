"""A lake brought up to date step by step beside one made from the last raw folder at once."""

import pytest
from pyspark.sql import functions as F
from settings import session_settings
from test_medallion import PBJ_FILE, PROVIDER_FILE

from verification.catalogue import _named_files
from wardstat import schemas as S
from wardstat.plans import lake as L
from wardstat.sources.files import file_manifest, layout_report, manifest_changes, read_csv
from wardstat.sources.versions import current, folders, live, read_published, values

HEAD, *DAYS = PBJ_FILE.strip().split("\n")
MORE = ["01B000,Elm,Waco,TX,20240601,10,1,1,0,2,2,0,3,3,0", "01A193,Oak,Waco,TX,,5,1,1,0,1,1,0,1,1,0"]


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    old = path.stat().st_mtime if path.exists() else 0
    path.write_text(text)
    if path.stat().st_mtime <= old + 1:  # a later version, whatever the clock
        import os
        os.utime(path, (old + 2, old + 2))


def days(folder, name, lines):
    put(folder, f"{S.PBJ}/{name}.csv", "\n".join([HEAD, *lines]) + "\n")


def tables(spark, lake, version=None):
    return {name: sorted(map(tuple, L.read_lake(spark, lake, name, version).collect()), key=repr) for name in S.GOLD_TABLES}


@pytest.fixture
def start(spark, tmp_path):
    """A raw folder of two files of days and one of providers, and its lake."""
    raw, lake = tmp_path / "raw", str(tmp_path / "lake")
    days(raw, "first [1]", DAYS[:2])
    days(raw, "second", DAYS[2:])
    put(raw, f"{S.PROVIDER}.csv", PROVIDER_FILE)
    put(raw, f"{S.SURVEY_DATES}/a=b.csv", "CMS Certification Number (CCN),Survey Date\n015009,2023-01-05\n")
    put(raw, "unknown/x.csv", "a\n1\n")
    assert L.refresh(spark, str(raw), lake) == 1
    return raw, lake


def same_as_at_once(spark, raw, lake, tmp_path, label="whole"):
    whole = str(tmp_path / label)
    L.refresh(spark, str(raw), whole)
    assert tables(spark, lake) == tables(spark, whole)
    for name in (S.PBJ, S.PROVIDER, S.SURVEY_DATES):
        assert sorted(map(tuple, L.read_silver(spark, lake, name).collect()), key=repr) == sorted(
            map(tuple, L.read_silver(spark, whole, name).collect()), key=repr)


def entries(spark, lake, table):
    return {e.partition: e.run for e in live(current(spark, lake)[0], table)}


def test_a_second_refresh_writes_nothing(spark, start, tmp_path):
    raw, lake = start
    before = sorted((tmp_path / "lake").rglob("*"))
    assert L.refresh(spark, str(raw), lake) == 1
    assert sorted((tmp_path / "lake").rglob("*")) == before
    assert {r.PROVNUM: r.TOTAL_NURSE_HOURS for r in L.read_lake(spark, lake, "staffing_metrics").where("MONTH = 4").collect()} == {
        "015009": 200.0, "01A193": 4.0}


def test_new_corrected_and_moved_days(spark, start, tmp_path):
    raw, lake = start
    old = entries(spark, lake, "gold/staffing_metrics")
    days(raw, "third", MORE)  # a month of its own, and a day without a date
    second = [DAYS[2].replace(",40,", ",44,"), DAYS[3].replace(",TX,", ",OK,")]
    days(raw, "second", second)  # a corrected day, and a facility in another state
    assert L.refresh(spark, str(raw), lake) == 2
    same_as_at_once(spark, raw, lake, tmp_path)
    new = entries(spark, lake, "gold/staffing_metrics")
    assert "STATE=TX/YEAR=2024/MONTH=4" in old and "STATE=TX/YEAR=2024/MONTH=4" not in new
    assert "STATE=OK/YEAR=2024/MONTH=4" in new
    assert new["STATE=AL/YEAR=2024/MONTH=4"] == old["STATE=AL/YEAR=2024/MONTH=4"]  # not touched, not written
    assert new["STATE=AL/YEAR=2024/MONTH=5"] != old["STATE=AL/YEAR=2024/MONTH=5"]
    assert len(tables(spark, lake, version=1)["staffing_metrics"]) == 3  # the earlier version is still there


def test_gone_files_and_new_providers(spark, start, tmp_path):
    raw, lake = start
    old = entries(spark, lake, "gold/staffing_metrics")
    put(raw, f"{S.PROVIDER}.csv", PROVIDER_FILE.replace(",AL,80,", ",GA,100,").replace(",AL,90,", ",GA,110,"))
    L.refresh(spark, str(raw), lake)
    assert entries(spark, lake, "gold/staffing_metrics") == old
    assert {values(p)["STATE"] for p in entries(spark, lake, "gold/facility_metrics")} == {"GA", "TX"}
    (raw / S.PBJ / "second.csv").unlink()
    L.refresh(spark, str(raw), lake)
    same_as_at_once(spark, raw, lake, tmp_path)
    (raw / S.PBJ / "first [1].csv").unlink()
    L.refresh(spark, str(raw), lake)
    left = tables(spark, lake)
    assert left["staffing_metrics"] == [] and left["top_patient_volume"] == [] and len(left["facility_metrics"]) == 3
    (raw / f"{S.PROVIDER}.csv").unlink()
    L.refresh(spark, str(raw), lake)
    assert not any(tables(spark, lake).values()) and L.read_silver(spark, lake, S.SURVEY_DATES).count() == 1


def test_a_file_without_rows_is_landed_once(spark, start, tmp_path):
    raw, lake = start
    days(raw, "empty", [])
    assert L.refresh(spark, str(raw), lake) == 2
    assert L.refresh(spark, str(raw), lake) == 2
    same_as_at_once(spark, raw, lake, tmp_path)


@pytest.mark.parametrize("broken", ["facility_metrics", "publish"])
def test_a_broken_run_changes_nothing(spark, start, tmp_path, monkeypatch, broken):
    """Whatever was written before the failure, all tables read as before; the next run makes up for it."""
    raw, lake = start
    before = tables(spark, lake)
    silver = L.read_silver(spark, lake, S.PBJ).count()
    days(raw, "second", [line.replace(",TX,", ",OK,") for line in DAYS[2:]])
    days(raw, "third", MORE)
    put(raw, f"{S.PROVIDER}.csv", PROVIDER_FILE.replace(",AL,", ",GA,"))

    def fail(self, name, *rest):
        if broken in ("publish", name):
            raise OSError("the run ends here")
        return whole(self, name, *rest)

    whole = L._Refresh.publish if broken == "publish" else L._Refresh._write
    with monkeypatch.context() as patch:
        patch.setattr(L._Refresh, "publish" if broken == "publish" else "_write", fail)
        with pytest.raises(OSError):
            L.refresh(spark, str(raw), lake)
    assert tables(spark, lake) == before and L.read_silver(spark, lake, S.PBJ).count() == silver
    L.refresh(spark, str(raw), lake)
    same_as_at_once(spark, raw, lake, tmp_path)


def test_layouts_with_another_order_and_a_new_column(spark, start, tmp_path):
    raw, lake = start
    cells = [line.replace('"Maple, Inc"', "Maple").split(",") for line in (HEAD, *MORE)]
    turned = [",".join([*reversed(c), "NOTE" if c[0] == "PROVNUM" else "n"]) for c in cells]
    put(raw, f"{S.PBJ}/third.csv", "\n".join(turned) + "\n")
    days(raw, "second", [line.replace(",TX,", ",OK,") for line in DAYS[2:]])  # both layouts in one refresh
    put(raw, f"{S.PBJ}/nothing.csv", "")
    L.refresh(spark, str(raw), lake)
    got = L.read_silver(spark, lake, S.PBJ)
    assert got.count() == 6 and got.where("NOTE = 'n'").count() == 2
    assert {r.STATE for r in L.read_lake(spark, lake, "staffing_metrics").where("MONTH = 6").collect()} == {"TX"}
    report = {(r.layout, r.column_name): (r.n_files, r.position) for r in layout_report(spark, f"{raw}/{S.PBJ}").collect()}
    assert report[1, "PROVNUM"] == (2, 1) and report[2, "PROVNUM"] == (1, 15)
    assert report[1, "NOTE"] == (2, None) and report[2, "NOTE"] == (1, 16)


def test_manifest_changes(spark, tmp_path):
    for name in ("same.csv", "gone.csv", "sub/changed.csv"):
        put(tmp_path, name, "a\n1\n")
    before = spark.createDataFrame(
        file_manifest(spark, str(tmp_path)).collect(), file_manifest(spark, str(tmp_path)).schema)
    (tmp_path / "gone.csv").unlink()
    put(tmp_path, "sub/changed.csv", "a\n2\n")
    put(tmp_path, "new.csv", "a\n")
    made = manifest_changes(before, file_manifest(spark, str(tmp_path)))
    assert {r.relative_path: r.change for r in made.collect()} == {"gone.csv": "gone", "sub/changed.csv": "changed", "new.csv": "new"}
    assert made.where(F.col("new_length") == 2).count() == 1


def test_nothing_published(spark, tmp_path):
    assert current(spark, str(tmp_path / "none")) == ([], 0)
    assert read_published(spark, str(tmp_path / "none"), "t", "a int").count() == 0
    (tmp_path / "raw").mkdir()
    assert L.refresh(spark, str(tmp_path / "raw"), str(tmp_path / "lake")) == 0


def test_the_fewest_folders():
    live_ones = ["a=1/b=1", "a=1/b=2", "a=2/b=1", "a=3/b=1"]
    assert folders(live_ones, []) == [""] and folders([""], []) == [""]
    assert folders(live_ones, ["a=2/b=2"]) == ["a=1", "a=2/b=1", "a=3"]
    assert folders(live_ones, ["a=4/b=2", "a=1/b=3"]) == ["a=1/b=1", "a=1/b=2", "a=2", "a=3"]


def test_named_files_hold_all_parts(spark, tmp_path):
    """Rows that are written in several parts, and a name without rows whose old file goes."""
    put(tmp_path / "raw", "2.csv", "old\n1\n")
    rows = spark.range(40_000).select(
        F.col("id").alias("number"), F.sha2(F.col("id").cast("string"), 256).alias('a "name", quoted'), (F.col("id") % 10 == 0).cast("int").alias("file"))
    with session_settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}):
        _named_files(spark, rows, str(tmp_path / "raw"), ["0.csv", "1.csv", "2.csv"])
    assert sorted(p.name for p in (tmp_path / "raw").glob("*.csv")) == ["0.csv", "1.csv"]
    header, *lines = (tmp_path / "raw/0.csv").read_text().splitlines()
    assert len(lines) == len(set(lines)) == 36_000 and header not in lines
    made = read_csv(spark, str(tmp_path / "raw"))
    expected = rows.select(F.col("number").cast("string"), 'a "name", quoted')
    assert made.count() == 40_000 and made.exceptAll(expected).count() == 0
