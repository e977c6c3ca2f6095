import os
import time

import pytest
from pyspark.sql import functions as F
from settings import session_settings

from wardstat import schemas as S
from wardstat.plans import medallion as M
from wardstat.session import scratch_path
from wardstat.sources import catalog
from wardstat.sources.files import file_manifest, read_csv, read_gold, with_lineage
from wardstat.sources.sinks import write_dataset
from wardstat.streaming import bronze
from wardstat.streaming.bronze import incremental_bronze


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_manifest_lists_csv_files_only(spark, tmp_path):
    root = tmp_path / "raw files"
    put(root / "a b.csv", "x\n1\n")
    put(root / "sub" / "c+1.CSV", "x\n1\n2\n")
    put(root / "notes.txt", "no")
    (root / "empty").mkdir()
    for path in (str(root), f"file://{root}/"):
        got = rows(file_manifest(spark, path).select("relative_path", "file_name", "length"))
        assert got == [("a b.csv", "a b.csv", 4), ("sub/c+1.CSV", "c+1.CSV", 6)]


def test_manifest_reads_no_content(spark, tmp_path):
    put(tmp_path / "a.csv", "x\n1\n")
    plan = file_manifest(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_csv_is_text_and_keeps_ids(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'CCN (id),Name\n015009,"Maple, Inc"\n01A193,Zoë\n')
    df = read_csv(spark, path)
    assert df.dtypes == [("CCN (id)", "string"), ("Name", "string")]
    assert rows(df) == [("015009", "Maple, Inc"), ("01A193", "Zoë")]


def test_short_and_long_csv_rows_are_kept(spark, tmp_path):
    path = put(tmp_path / "a.csv", "a,b\n1\n2,3,4\n5,6\n")
    assert rows(read_csv(spark, path, unfit="whole")) == [
        ("1", None, "1"), ("2", "3", "2,3,4"), ("5", "6", None)]


def test_quoted_text(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'a,b\n1,"say ""hi"""\n2,"x\ny"\n')
    assert rows(read_csv(spark, path, multi_line=True)) == [("1", 'say "hi"'), ("2", "x\ny")]


def test_a_schema_does_not_swap_columns(spark, tmp_path):
    path = put(tmp_path / "a.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header|FAILED_READ_FILE"):
        read_csv(spark, path, "a string, b string").collect()


def test_files_with_another_header_are_refused(spark, tmp_path):
    put(tmp_path / "d" / "1.csv", "a,b\n1,2\n")
    put(tmp_path / "d" / "2.csv", "b,a\n4,3\n")
    with pytest.raises(Exception, match="(?i)header|FAILED_READ_FILE"):
        read_csv(spark, str(tmp_path / "d")).collect()


def test_bronze_lands_every_file_under_its_name(spark, tmp_path):
    raw, bronze = tmp_path / "raw", tmp_path / "bronze"
    put(raw / "one.csv", "a,b c\n1,x\n2,\n")
    put(raw / "deep" / "two.csv", "k\n1\n")
    put(raw / "x [1].csv", "k\n1\n2\n3\n")
    report = M.run_bronze(spark, str(raw), str(bronze))
    # One data set for each header, named for its first file.
    assert rows(report) == [
        ("deep~1two", "deep/two.csv", 1), ("deep~1two", "x [1].csv", 3), ("one", "one.csv", 2)]
    landed = spark.read.parquet(str(bronze / "one"))
    assert landed.columns == ["a", "b c", *S.LANDING_COLUMNS]
    assert rows(landed.select("a", "b c", S.UNFIT_ROW, S.SOURCE_FILE)) == [
        ("1", "x", None, "one.csv"), ("2", None, None, "one.csv")]


@pytest.mark.parametrize("root", ["raw", "raw files+%20"])
def test_source_files_of_any_name(spark, tmp_path, root):
    """Below a root of plain characters only names with an escape are decoded, not every row's whole path."""
    names = ["plain.csv", "a b.csv", "c+d.csv", "e%20f.csv", "ü/g.csv", f"deep{tmp_path}/{root}/h.csv"]
    for name in names:
        put(tmp_path / root / name, "k\n1\n")
    found = spark.read.option("recursiveFileLookup", "true").text(str(tmp_path / root)).where("value = '1'")
    landed = with_lineage(found, str(tmp_path / root))
    assert sorted(r[S.SOURCE_FILE] for r in landed.collect()) == sorted(names)
    assert landed.columns == ["value", S.SOURCE_FILE, S.MODIFIED_AT, S.INGESTED_AT]
    plan = landed._jdf.queryExecution().executedPlan().toString()
    assert (f"Contains({S.SOURCE_FILE}" in plan) == (root == "raw")


@pytest.mark.parametrize("names", [("a.csv", "a/b.csv"), ("b/a.csv", "b.csv")])
def test_no_data_set_lies_in_another(spark, tmp_path, names):
    raw, bronze = tmp_path / "raw", tmp_path / "bronze"
    for i, name in enumerate(names):
        put(raw / name, f"k{i}\n1\n")
    assert sorted(r.source_file for r in M.run_bronze(spark, str(raw), str(bronze)).collect()) == sorted(names)


def test_equal_names_in_two_folders(spark, tmp_path):
    raw = tmp_path / "raw"
    put(raw / "q1" / "pbj.csv", "a\n1\n")
    put(raw / "q2" / "pbj.CSV", "a\n2\n3\n")
    report = M.run_bronze(spark, str(raw), str(tmp_path / "b"), {"pbj": "*/pbj.[cC][sS][vV]"})
    assert rows(report) == [("pbj", "q1/pbj.csv", 1), ("pbj", "q2/pbj.CSV", 2)]


def test_bronze_by_pattern(spark, tmp_path):
    raw, bronze = tmp_path / "raw", tmp_path / "bronze"
    put(raw / "pbj_q1.csv", "a\n1\n")
    put(raw / "pbj_q2.csv", "a\n2\n3\n")
    put(raw / "other.csv", "z\n1\n")
    report = M.run_bronze(spark, str(raw), str(bronze), {"pbj": "pbj_*.csv"})
    assert rows(report) == [("pbj", "pbj_q1.csv", 1), ("pbj", "pbj_q2.csv", 2)]


def test_bronze_of_an_empty_folder(spark, tmp_path):
    put(tmp_path / "raw" / "readme.txt", "nothing here")
    assert M.run_bronze(spark, str(tmp_path / "raw"), str(tmp_path / "bronze")).count() == 0


def test_incremental_bronze_lands_each_file_once(spark, tmp_path):
    raw, out, progress = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "progress")
    put(raw / "1.csv", "a,b\n1,x\n")
    assert incremental_bronze(spark, str(raw), out, progress).count() == 1
    put(raw / "2.csv", "a,b\n2,y\n3,z\n")
    put(raw / "skip.txt", "a,b\n9,9\n")
    loaded = incremental_bronze(spark, str(raw), out, progress, files_per_batch=1)
    assert rows(loaded.select("a", S.SOURCE_FILE)) == [
        ("1", "1.csv"), ("2", "2.csv"), ("3", "2.csv")]
    assert incremental_bronze(spark, str(raw), out, progress).count() == 3


def test_incremental_bronze_lands_old_files(spark, tmp_path):
    raw, out, progress = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "progress")
    put(raw / "1.csv", "a\n1\n")
    assert incremental_bronze(spark, str(raw), out, progress).count() == 1
    late = put(raw / "2.csv", "a\n2\n")
    month_ago = time.time() - 30 * 86400
    os.utime(late, (month_ago, month_ago))
    assert incremental_bronze(spark, str(raw), out, progress).count() == 2


def test_incremental_bronze_counts_the_latest_version(spark, tmp_path, monkeypatch):
    raw, out, progress = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "progress")
    put(raw / "1.csv", "a\n1\n")
    put(raw / "2.csv", "a\n9\n")
    incremental_bronze(spark, str(raw), out, progress)

    def rewrite(name, text, seconds):
        path = put(raw / name, text)
        os.utime(path, (time.time() + seconds, time.time() + seconds))

    def landed():
        return sorted(r.a for r in incremental_bronze(spark, str(raw), out, progress).collect())

    rewrite("1.csv", "a\n1\n2\n", 60)
    assert landed() == ["1", "2", "9"]
    put(raw / "3.csv", "a\n3\n")  # later calls work as any other
    assert landed() == ["1", "2", "3", "9"]
    rewrite("1.csv", "a\n", 120)
    rewrite("3.csv", "a\n4\n", 120)
    with monkeypatch.context() as patch:  # a call that breaks off when all is landed
        keep = bronze._keep
        patch.setattr(bronze, "_keep", lambda listing, folder, version: keep(listing, folder, version)
                      if folder.endswith("begun") else (_ for _ in ()).throw(OSError("broken off")))
        with pytest.raises(OSError):
            landed()
    rewrite("2.csv", "a\n8\n", 180)
    assert landed() == ["4", "8"] and landed() == ["4", "8"]
    put(raw / "5[a].csv", "a\n5\n")
    with pytest.raises(ValueError, match="5.a..csv"):
        landed()


def test_database_locations_are_quoted(spark, tmp_path):
    place = tmp_path / "it's here"
    catalog.create_database(spark, "ward_quoted", str(place))
    assert "it's here" in spark.catalog.getDatabase("ward_quoted").locationUri.replace("%20", " ")


def test_incremental_bronze_refuses_another_header(spark, tmp_path):
    raw, out, progress = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "progress")
    put(raw / "1.csv", "a,b\n1,x\n")
    schema = "b string, a string"
    with pytest.raises(Exception):
        incremental_bronze(spark, str(raw), out, progress, schema=schema)


def gold_rows(spark, *keys):
    numbers = S.GOLD_NUMBERS["staffing_metrics"]
    schema = "PROVNUM string, PROVNAME string, STATE string, YEAR int, MONTH int, " + ", ".join(
        f"{c} double" for c in numbers)
    return spark.createDataFrame(
        [(p, "n", s, y, m, *[float(i) for i in range(len(numbers))]) for p, s, y, m in keys], schema)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_gold_partitions_keep_their_types(spark, tmp_path, fmt):
    df = gold_rows(spark, ("1", "01", 2024, 4), ("2", None, 2024, 5), ("3", "TX", None, None))
    M.write_gold(df, str(tmp_path), "staffing_metrics", fmt)
    back = read_gold(spark, str(tmp_path), "staffing_metrics", fmt)
    assert back.columns[-3:] == ["STATE", "YEAR", "MONTH"]
    assert rows(back.select(df.columns)) == rows(df)


def test_a_partition_is_one_file(spark, tmp_path):
    df = gold_rows(spark, *[(str(i), "TX", 2024, 4) for i in range(400)]).repartition(8)
    M.write_gold(df, str(tmp_path), "staffing_metrics")
    assert len(list(tmp_path.rglob("*.parquet"))) == 1


def test_a_partition_is_one_file_without_adaptive_execution(spark, tmp_path):
    df = gold_rows(spark, *[(str(i), s, 2024, 4) for i in range(100) for s in ("TX", "AL")])
    with session_settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        M.write_gold(df.repartition(8), str(tmp_path), "staffing_metrics")
    assert len(list(tmp_path.rglob("*.parquet"))) == 2


def test_a_hot_partition_is_split(spark, tmp_path):
    """Most rows in one state: several tasks share its folder, no row is lost."""
    df = spark.range(0, 200000, numPartitions=8).selectExpr(
        "sha2(cast(id AS string), 256) AS PROVNUM",
        "CASE WHEN id % 3 < 2 THEN 'TX' ELSE concat('S', id % 40) END AS STATE")
    with session_settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}):
        write_dataset(df, str(tmp_path / "t"), partition_by=["STATE"])
    assert len(list((tmp_path / "t" / "STATE=TX").glob("*.parquet"))) > 4
    assert len(list((tmp_path / "t" / "STATE=S2").glob("*.parquet"))) == 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200000


def test_replacing_some_partitions_only(spark, tmp_path):
    first = gold_rows(spark, ("1", "TX", 2024, 4), ("1", "TX", 2024, 5))
    M.write_gold(first, str(tmp_path), "staffing_metrics")
    again = gold_rows(spark, ("2", "TX", 2024, 5))
    M.write_gold(again, str(tmp_path), "staffing_metrics", replace_partitions_only=True)
    kept = read_gold(spark, str(tmp_path), "staffing_metrics").select("PROVNUM", "MONTH")
    assert rows(kept) == [("1", 4), ("2", 5)]
    M.write_gold(again, str(tmp_path), "staffing_metrics")
    assert read_gold(spark, str(tmp_path), "staffing_metrics").count() == 1


def test_state_filter_prunes_partitions(spark, tmp_path):
    M.write_gold(gold_rows(spark, ("1", "TX", 2024, 4), ("2", "AL", 2024, 4)), str(tmp_path),
                 "staffing_metrics")
    df = read_gold(spark, str(tmp_path), "staffing_metrics").filter(F.col("STATE") == "TX")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "STATE" in plan.split("PartitionFilters: ")[1].split("]")[0]


def test_top_list_is_one_file(spark, tmp_path):
    df = spark.range(20).selectExpr("cast(id AS string) AS a").repartition(5)
    write_dataset(df, str(tmp_path / "t"), fmt="csv", single_file=True)
    assert len(list((tmp_path / "t").glob("*.csv"))) == 1


def test_tables(spark):
    path = scratch_path(spark, "db")
    catalog.create_database(spark, "ward_test", path)
    catalog.create_database(spark, "ward_test", path)
    catalog.save_table(spark.sql("SELECT 1 AS a, 2 AS b"), "ward_test.t")
    catalog.save_table(spark.sql("SELECT 'x' AS other"), "ward_test.t")
    assert rows(catalog.select_all(spark, "ward_test.t")) == [("x",)]
    assert catalog.read_table(spark, "ward_test.t").columns == ["other"]
    assert spark.catalog.tableExists("ward_test.t")


def test_gold_views_and_previews(spark, tmp_path):
    from test_serving import FACILITY, QUALITY, VOLUME
    M.write_gold(gold_rows(spark, *[(str(i), "TX", 2024, 4) for i in range(30)]), str(tmp_path),
                 "staffing_metrics")
    for name, schema in (("facility_metrics", FACILITY), ("quality_metrics", QUALITY),
                         ("top_patient_volume", VOLUME)):
        M.write_gold(spark.createDataFrame([], schema), str(tmp_path), name)
    assert set(catalog.register_gold(spark, str(tmp_path))) == set(S.GOLD_TABLES)
    assert spark.sql("select provnum, state from staffing_metrics where month = 4").count() == 30
    assert catalog.preview(spark.table("staffing_metrics")).count() == 10
    first = catalog.preview(spark.table("staffing_metrics"), 2, order_by=["PROVNUM"])
    assert [r.PROVNUM for r in first.collect()] == ["0", "1"]
    assert catalog.select_columns(spark, "facility_metrics").columns == list(catalog.FACILITY_VIEW)


def test_profile_of_a_saved_table(spark):
    catalog.create_database(spark, "ward_profile", scratch_path(spark, "db"))
    df = spark.createDataFrame([("1", None), (None, None)], "`a (b)` string, `c d` string")
    out = M.profile_table(df, "ward_profile.t", "ward_profile.t_nulls")
    assert [tuple(r) for r in out.collect()] == [("c_d", 2), ("a_b", 1)]
    assert spark.table("ward_profile.t").columns == ["a_b", "c_d"]


def test_scratch_needs_a_shared_folder_off_local(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(Session(), "x")
    monkeypatch.setattr(Conf, "get", lambda self, key, default=None: {
        "spark.master": "local-cluster[2,1,1024]"}.get(key, default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(Session(), "x")
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
