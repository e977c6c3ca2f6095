"""Every operator as a named query ``(spark, sf_dir) -> DataFrame``."""

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from verification import views as V
from wardstat import schemas as S
from wardstat.functions.conversions import to_work_date
from wardstat.functions.metrics import exact_mean, exact_sum
from wardstat.operators import columns as C
from wardstat.operators import profiling as P
from wardstat.plans import gold as G
from wardstat.plans import lake as L
from wardstat.plans import medallion as M
from wardstat.plans import serving as D
from wardstat.session import scratch_path
from wardstat.sources import catalog, files
from wardstat.sources.files import file_manifest, read_csv, read_gold
from wardstat.sources.sinks import write_dataset
from wardstat.streaming.bronze import incremental_bronze

STATE = "NATION_7"
QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


# --- gold tables -------------------------------------------------------------

@query
def staffing_metrics(spark, sf_dir):
    return V.staffing(spark, sf_dir)


@query
def staffing_metrics_flat(spark, sf_dir):
    """The same table from the flat daily file."""
    return G.staffing_metrics(G.monthly_rollup(G.prepare_daily(V.pbj(spark, sf_dir))))


@query
def monthly_rollup(spark, sf_dir):
    return V.rollup(spark, sf_dir)


@query
def facility_avg_ratio(spark, sf_dir):
    return V.mean_ratios(spark, sf_dir)


@query
def facility_metrics(spark, sf_dir):
    return V.facility(spark, sf_dir)


@query
def quality_metrics(spark, sf_dir):
    return V.quality(spark, sf_dir)


@query
def patient_volume(spark, sf_dir):
    return V.volume(spark, sf_dir)


@query
def patient_volume_from_rollup(spark, sf_dir):
    return G.patient_volume(V.rollup(spark, sf_dir), census=G.CENSUS_DAYS)


@query
def top_patient_volume(spark, sf_dir):
    return G.top_patient_volume(V.volume(spark, sf_dir))


# --- serving -----------------------------------------------------------------

@query
def kpi_cards(spark, sf_dir):
    staffing, facility, quality = V.served(spark, sf_dir)
    return D.kpi_cards(facility, staffing, quality)


@query
def kpi_cards_state(spark, sf_dir):
    staffing, facility, quality = V.served(spark, sf_dir, STATE)
    return D.kpi_cards(facility, staffing, quality)


@query
def state_filter(spark, sf_dir):
    return V.staffing(spark, sf_dir, STATE)


@query
def kpi_cards_nowhere(spark, sf_dir):
    """Key figures of a state without rows."""
    staffing, facility, quality = V.served(spark, sf_dir, "NOWHERE")
    return D.kpi_cards(facility, staffing, quality)


@query
def state_list(spark, sf_dir):
    return D.state_list(V.facility(spark, sf_dir))


@query
def hours_by_staff_type(spark, sf_dir):
    return D.hours_by_staff_type(V.staffing(spark, sf_dir))


@query
def employee_vs_contract(spark, sf_dir):
    return D.employee_vs_contract(V.staffing(spark, sf_dir))


@query
def avg_quality_ratings(spark, sf_dir):
    return D.average_ratings(V.quality(spark, sf_dir))


@query
def top_occupancy(spark, sf_dir):
    return G.top_occupancy(V.providers(spark, sf_dir), V.daily(spark, sf_dir), V.facilities(spark, sf_dir))


@query
def top_pressure(spark, sf_dir):
    return D.top_pressure(V.facility(spark, sf_dir))


@query
def top_quality(spark, sf_dir):
    return D.top_quality(V.quality(spark, sf_dir))


@query
def mean_nurse_ratio(spark, sf_dir):
    return D.mean_nurse_ratio(V.staffing(spark, sf_dir))


@query
def top_nurse_ratio(spark, sf_dir):
    return D.top_nurse_ratio(V.staffing(spark, sf_dir))


@query
def top_volume(spark, sf_dir):
    return D.top_volume(top_patient_volume(spark, sf_dir))


@query
def top_volume_in_state(spark, sf_dir):
    """Which of the overall top ten lie in the state."""
    return D.top_volume(D.in_state(top_patient_volume(spark, sf_dir), STATE))


@query
def state_top_volume(spark, sf_dir):
    """The top ten of the state."""
    return D.top_volume(V.volume(spark, sf_dir, STATE))


@query
def state_tops_of_pressure(spark, sf_dir):
    """The three facilities under the greatest pressure in every state."""
    return D.state_tops(V.facility(spark, sf_dir), "STAFFING_PRESSURE_INDEX", 3)


@query
def state_tops_of_volume(spark, sf_dir):
    """The two facilities with the most patient days in every state."""
    return D.state_tops(V.volume(spark, sf_dir), "TOTAL_PATIENT_DAYS", 2)


@query
def facility_sketches(spark, sf_dir):
    """Facilities of the whole flat file, and of one state, by saved sketches: whether they are within five hundredths."""
    path = write_dataset(D.facility_sketches(V.pbj(spark, sf_dir)), scratch_path(spark, "sketches"))
    saved = spark.read.parquet(path)
    parts = [D.estimated_facilities(rows).select(F.lit(name).alias("scope"), "TOTAL_FACILITIES")
             for name, rows in (("all", saved), (STATE, D.in_state(saved, STATE)))]
    days = V.pbj(spark, sf_dir)
    exact = [rows.agg(F.count_distinct("PROVNUM").alias("exact")).select(F.lit(name).alias("scope"), "exact")
             for name, rows in (("all", days), (STATE, D.in_state(days, STATE)))]
    both = parts[0].union(parts[1]).join(exact[0].union(exact[1]), "scope")
    off = F.abs(F.col("TOTAL_FACILITIES") - F.col("exact"))
    return both.select("scope", "exact", (off <= 0.05 * F.col("exact")).alias("close"))


@query
def state_filter_flat(spark, sf_dir):
    """The filter set on the finished table: Spark moves it to the facilities."""
    return D.in_state(staffing_metrics_flat(spark, sf_dir), STATE)


@query
def quality_heatmap(spark, sf_dir):
    return D.quality_heatmap(V.quality(spark, sf_dir))


@query
def staffing_heatmap(spark, sf_dir):
    return D.staffing_heatmap(V.staffing(spark, sf_dir))


@query
def quality_heatmap_long(spark, sf_dir):
    return D.to_long(quality_heatmap(spark, sf_dir), "STATE", D.QUALITY_MEASURES)


@query
def staffing_heatmap_long(spark, sf_dir):
    return D.to_long(staffing_heatmap(spark, sf_dir), "STATE", D.STAFFING_MEASURES)


# --- profiling ---------------------------------------------------------------

@query
def null_summary(spark, sf_dir):
    return P.most_nulls_first(P.null_summary(V.pbj(spark, sf_dir)))


@query
def null_summary_provider(spark, sf_dir):
    return P.null_summary(V.provider_file(spark, sf_dir))


@query
def null_counts(spark, sf_dir):
    return P.null_counts(V.provider_rows(spark, sf_dir))


@query
def null_summary_by_column(spark, sf_dir):
    both = P.null_summary(V.pbj(spark, sf_dir)).unionByName(
        P.null_summary(V.provider_rows(spark, sf_dir)))
    return P.nulls_by_column(both)


@query
def null_summary_row_count(spark, sf_dir):
    return P.row_count(P.null_summary(V.pbj(spark, sf_dir)))


@query
def null_counts_of_files(spark, sf_dir):
    """Null counts of the days as a Parquet dataset, by the files' footers."""
    path = write_dataset(V.pbj(spark, sf_dir), scratch_path(spark, "days"))
    return P.null_counts_of_files(spark, path)


@query
def duplicate_documents_by_digest(spark, sf_dir):
    """As ``duplicate_documents``: digests are counted, whole texts are compared where one occurs twice."""
    return P.duplicate_rows_by_digest(V.table(spark, sf_dir, "documents").drop("doc_id"))


@query
def row_count_of_days(spark, sf_dir):
    return P.row_count(V.pbj(spark, sf_dir))


@query
def duplicate_rows(spark, sf_dir):
    return P.duplicate_rows(V.provider_copies(spark, sf_dir))


@query
def duplicate_documents(spark, sf_dir):
    """Whole texts that occur more than once in a source and language."""
    return P.duplicate_rows(V.table(spark, sf_dir, "documents").drop("doc_id"))


@query
def drop_exact_duplicates(spark, sf_dir):
    return P.drop_exact_duplicates(V.provider_copies(spark, sf_dir))


@query
def dedup_by_key(spark, sf_dir):
    return V.providers(spark, sf_dir)


# --- columns -----------------------------------------------------------------

@query
def coerce_numeric(spark, sf_dir):
    text = F.expr("""
        CASE c_custkey % 11 WHEN 1 THEN '1d' WHEN 2 THEN '1_000' WHEN 3 THEN 'NaN'
             WHEN 4 THEN ' 12 ' WHEN 5 THEN '1e3' WHEN 6 THEN '0x10' WHEN 7 THEN ''
             WHEN 8 THEN '1,000'
             ELSE CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE cast(c_acctbal AS string) END
        END""")
    customers = V.table(spark, sf_dir, "customer").select("c_custkey", text.alias("amount"))
    return C.coerce_numeric(customers, ["amount", "not_there"])


@query
def work_date(spark, sf_dir):
    text = F.expr("""
        CASE o_orderkey % 4 WHEN 0 THEN date_format(o_orderdate, 'yyyyMMdd')
             WHEN 1 THEN date_format(o_orderdate, 'yyyy-MM-dd')
             WHEN 2 THEN CASE o_orderkey % 3 WHEN 0 THEN date_format(o_orderdate, 'yyyyMM') || '1'
                  WHEN 1 THEN date_format(o_orderdate, 'yyyy')
                  ELSE date_format(o_orderdate, 'yyyy-MM-dd') || 'Tjunk' END
             ELSE date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') END""")
    orders = V.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("day"))
    return orders.select("o_orderkey", to_work_date(F.col("day")).alias("work_date")).select(
        "*", F.year("work_date").alias("YEAR"), F.month("work_date").alias("MONTH"))


@query
def prepared_days(spark, sf_dir):
    """Days typed from text, with year, month and total hours."""
    text = V.days(spark, sf_dir)
    text = text.select(*[F.col(c).cast("string").alias(c) for c in text.columns])
    return G.prepare_daily(text)


@query
def drop_footnotes(spark, sf_dir):
    return C.drop_if_present(V.provider_file(spark, sf_dir), S.SILVER_DROPPED)


@query
def sanitize_names(spark, sf_dir):
    return C.sanitize_columns(V.provider_file(spark, sf_dir))


@query
def standardize_names(spark, sf_dir):
    return C.standardize_columns(V.provider_file(spark, sf_dir))


@query
def select_rename(spark, sf_dir):
    return G.provider_model(V.provider_file(spark, sf_dir))


@query
def select_rename_sanitized(spark, sf_dir):
    return G.provider_model(C.sanitize_columns(V.provider_file(spark, sf_dir)))


@query
def schema_report(spark, sf_dir):
    return C.column_profile(V.table(spark, sf_dir, "lineitem"))


@query
def schema_listing(spark, sf_dir):
    return C.schema_report(V.table(spark, sf_dir, "lineitem"))


@query
def require_columns_failure(spark, sf_dir):
    """The rows of a table without one of the columns that serving needs, and what it is told."""
    facilities = V.providers(spark, sf_dir).select("PROVNUM", "PROVNAME")
    message = ""
    try:
        C.require_columns(facilities, ["STATE", "PROVNUM"])
    except ValueError as error:
        message = str(error)
    return facilities.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("message", F.lit(message))


# --- files and tables --------------------------------------------------------

def _raw_files(spark, sf_dir, *names):
    """The named extracts, or all four, as headered CSV; returns their folder."""
    raw = scratch_path(spark, "raw")
    pbj = V.pbj(spark, sf_dir)
    extracts = {
        S.PBJ: pbj.withColumn(S.WORK_DATE, F.date_format(S.WORK_DATE, "yyyyMMdd")),
        S.PROVIDER: V.provider_file(spark, sf_dir),
        S.STATE_AVERAGES: V.table(spark, sf_dir, "customer").groupBy(
            F.col("c_nationkey").alias("State (number)")).agg(
            F.count(F.lit(1)).alias("Facilities, counted")),
        S.SURVEY_DATES: V.table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("Survey Number"),
            F.col("o_orderdate").cast("date").alias("Survey Date (first)"),
            F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias(
                "QM Rating Footnote")),
    }
    for name in names or extracts:
        write_dataset(extracts[name], f"{raw}/{name}", fmt="csv")
    return raw


RAW_FOLDERS = {name: name for name in S.DATASETS}


@query
def csv_roundtrip(spark, sf_dir):
    path = write_dataset(V.pbj(spark, sf_dir), scratch_path(spark, "csv"), fmt="csv")
    return C.apply_types(read_csv(spark, path), numbers=S.PBJ_NUMBERS, dates=[S.WORK_DATE])


@query
def partitioned_roundtrip(spark, sf_dir):
    lake = scratch_path(spark, "gold")
    M.write_gold(V.facility(spark, sf_dir), lake, "facility_metrics")
    return read_gold(spark, lake, "facility_metrics")


@query
def partitioned_csv_roundtrip(spark, sf_dir):
    lake = scratch_path(spark, "gold-csv")
    M.write_gold(V.quality(spark, sf_dir), lake, "quality_metrics", fmt="csv")
    return read_gold(spark, lake, "quality_metrics", fmt="csv")


def _database(spark, label):
    path = scratch_path(spark, label)
    return catalog.create_database(spark, path.rsplit("/", 1)[1].replace("-", "_"), path)


@query
def table_roundtrip(spark, sf_dir):
    """Saved twice with different columns: the second schema replaces the first."""
    name = f"{_database(spark, 'tables')}.facility_metrics"
    catalog.save_table(V.provider_rows(spark, sf_dir), name)
    catalog.save_table(V.facility(spark, sf_dir), name, partition_by=["STATE"])
    return catalog.select_all(spark, name)


@query
def facility_projection(spark, sf_dir):
    name = f"{_database(spark, 'projection')}.facility_metrics"
    catalog.save_table(V.facility(spark, sf_dir), name, partition_by=["STATE"])
    return catalog.select_columns(spark, name)


@query
def catalog_setup(spark, sf_dir):
    """Gold tables registered in a database, with the rows of each."""
    database = _database(spark, "catalog")
    gold = {
        "staffing_metrics": V.staffing, "facility_metrics": V.facility,
        "quality_metrics": V.quality, "top_patient_volume": top_patient_volume,
    }
    counts = None
    for name, build in gold.items():
        catalog.save_table(build(spark, sf_dir), f"{database}.{name}")
        rows = P.row_count(catalog.read_table(spark, f"{database}.{name}"))
        part = rows.select(F.lit(name).alias("table_name"), F.col("count").alias("row_count"))
        counts = part if counts is None else counts.unionByName(part)
    return counts


@query
def profile_saved_table(spark, sf_dir):
    database = _database(spark, "profile")
    return M.profile_table(
        V.provider_file(spark, sf_dir), f"{database}.provider", f"{database}.null_summary")


@query
def csv_quotes_roundtrip(spark, sf_dir):
    """Text with quotes, commas and line breaks, out and back."""
    rows = V.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("part"),
        F.concat(F.lit('say "'), "p_name", F.lit('", ""twice""'), F.when(
            F.col("p_partkey") % 5 == 0, "\nnext line").otherwise("")).alias("said"))
    path = write_dataset(rows, scratch_path(spark, "quotes"), fmt="csv")
    return read_csv(spark, path, multi_line=True)


@query
def csv_swapped_header(spark, sf_dir):
    """What the reader makes of files whose columns come in another order than declared."""
    orders = V.table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey")
    path = write_dataset(orders, scratch_path(spark, "swapped"), fmt="csv")
    told = ""
    try:
        read_csv(spark, path, "o_orderkey string, o_orderstatus string").agg(F.max("o_orderkey")).collect()
    except (PySparkException, Py4JJavaError) as error:
        told = "header" if "CSV header does not conform to the schema" in str(error) else str(error)
    return orders.agg(F.count(F.lit(1)).alias("written")).withColumn("told", F.lit(told))


@query
def file_manifest_of_raw(spark, sf_dir):
    """All four extracts by the manifest: bytes of the rows, less one header per file, and whether the lines have as many.

    The bytes of the days are not stated: they hold hours as long fractions, which no two engines write alike.
    """
    raw = _raw_files(spark, sf_dir)
    header = F.create_map(*[F.lit(x) for name in S.DATASETS for x in (
        name, len(_header(spark, f"{raw}/{name}")))])
    dataset = F.element_at(F.split("relative_path", "/"), 1)
    listed = file_manifest(spark, raw).groupBy(dataset.alias("dataset")).agg(
        F.sum("length").alias("listed"), F.sum(F.when(dataset != S.PBJ, F.col("length") - header[dataset])).alias("row_bytes"),
        F.bool_and(F.col("relative_path") == F.concat(dataset, F.lit("/"), "file_name")).alias("names_agree"))
    lines = spark.read.option("recursiveFileLookup", "true").text(raw).select(
        F.element_at(F.split("_metadata.file_path", "/"), -2).alias("dataset"), (F.octet_length("value") + 1).alias("n"))
    read = lines.groupBy("dataset").agg(F.sum("n").alias("read"))
    return listed.join(read, "dataset").select(
        "dataset", "row_bytes", "names_agree", (F.col("listed") == F.col("read")).alias("bytes_agree"))


def _header(spark, path):
    names = [f'"{n}"' if "," in n else n for n in read_csv(spark, path).columns]
    return ",".join(names) + "\n"


@query
def file_manifest_bytes(spark, sf_dir):
    """Bytes of the survey rows by the manifest, less one header per file."""
    raw = _raw_files(spark, sf_dir, S.SURVEY_DATES)
    header = ",".join(read_csv(spark, f"{raw}/{S.SURVEY_DATES}").columns) + "\n"
    files = file_manifest(spark, f"{raw}/{S.SURVEY_DATES}")
    return files.agg((F.sum("length") - F.count(F.lit(1)) * len(header)).alias("row_bytes"))


@query
def bronze_load(spark, sf_dir):
    raw = _raw_files(spark, sf_dir, S.PROVIDER)
    return M.load_bronze(spark, raw, S.PROVIDER).drop(*S.LANDING_COLUMNS)


@query
def bronze_unfit_rows(spark, sf_dir):
    """Lines that hold more or fewer cells than the header, kept as they came, in eight files."""
    raw = scratch_path(spark, "unfit")
    key = F.col("p_partkey")
    line = F.concat_ws(",", key.cast("string"), F.when(key % 4 != 1, F.col("p_name")), F.when(key % 4 == 2, "more"))
    lines = V.table(spark, sf_dir, "part").select((key % 8).alias("file"), F.lit(1).alias("place"), line.alias("value"))
    headers = spark.range(8).select(F.col("id").alias("file"), F.lit(0).alias("place"), F.lit("number,name").alias("value"))
    headers.union(lines).repartition("file").sortWithinPartitions("file", "place").drop("place").write.partitionBy("file").text(raw)
    return M.load_bronze(spark, raw, "file=*").select("number", "name", S.UNFIT_ROW)


@query
def bronze_row_counts(spark, sf_dir):
    bronze = scratch_path(spark, "bronze")
    report = M.run_bronze(spark, _raw_files(spark, sf_dir), bronze, RAW_FOLDERS)
    return report.groupBy("dataset").agg(F.sum("row_count").alias("row_count"))


@query
def incremental_bronze_load(spark, sf_dir):
    raw = f"{_raw_files(spark, sf_dir, S.PROVIDER)}/{S.PROVIDER}"
    work = scratch_path(spark, "incremental")
    incremental_bronze(spark, raw, f"{work}/bronze", f"{work}/progress")
    loaded = incremental_bronze(spark, raw, f"{work}/bronze", f"{work}/progress")
    return loaded.drop(*S.LANDING_COLUMNS)


_SILVER = {}
_GOLD = {}


def _silver(spark, sf_dir):
    """Silver folder of one raw-to-silver run, made once per session and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SILVER:
        lake = scratch_path(spark, "lake")
        M.run_bronze(spark, _raw_files(spark, sf_dir), f"{lake}/bronze", RAW_FOLDERS)
        M.run_silver(spark, f"{lake}/bronze", f"{lake}/silver")
        _SILVER[key] = f"{lake}/silver"
    return _SILVER[key]


def _lake(spark, sf_dir):
    """Gold folder on top of it, likewise made once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _GOLD:
        silver = _silver(spark, sf_dir)
        _GOLD[key] = M.run_gold(spark, silver, silver.removesuffix("silver") + "gold")
    return _GOLD[key]


@query
def silver_provider(spark, sf_dir):
    return spark.read.parquet(f"{_silver(spark, sf_dir)}/{S.PROVIDER}")


@query
def silver_pbj(spark, sf_dir):
    return spark.read.parquet(f"{_silver(spark, sf_dir)}/{S.PBJ}")


@query
def silver_survey_dates(spark, sf_dir):
    return spark.read.parquet(f"{_silver(spark, sf_dir)}/{S.SURVEY_DATES}")


@query
def silver_state_averages(spark, sf_dir):
    return spark.read.parquet(f"{_silver(spark, sf_dir)}/{S.STATE_AVERAGES}")


@query
def staffing_from_raw(spark, sf_dir):
    return read_gold(spark, _lake(spark, sf_dir), "staffing_metrics")


@query
def facility_from_raw(spark, sf_dir):
    return read_gold(spark, _lake(spark, sf_dir), "facility_metrics")


@query
def quality_from_raw(spark, sf_dir):
    return read_gold(spark, _lake(spark, sf_dir), "quality_metrics")


@query
def volume_from_raw(spark, sf_dir):
    return read_gold(spark, _lake(spark, sf_dir), "top_patient_volume")


@query
def state_cards_from_raw(spark, sf_dir):
    """Key figures of one state over gold files: only its partitions are read."""
    gold = _lake(spark, sf_dir)
    tables = {name: read_gold(spark, gold, name) for name in S.GOLD_TABLES}
    return D.Dashboard.over(tables).for_state(STATE).kpi_cards()


@query
def gold_views(spark, sf_dir):
    """Facilities of each state, asked of the registered gold tables in SQL."""
    catalog.register_gold(spark, _lake(spark, sf_dir))
    return spark.sql("""
        SELECT f.STATE, count(*) AS facilities, count(q.FACILITY_QUALITY_SCORE) AS scored
        FROM facility_metrics f JOIN quality_metrics q ON f.PROVNUM = q.PROVNUM GROUP BY f.STATE""")


@query
def gold_of_one_month(spark, sf_dir):
    """The staffing table after a full run, and a second one over corrected days that replaces a single month."""
    silver = _silver(spark, sf_dir)
    work = scratch_path(spark, "gold-months")
    M.run_gold(spark, silver, f"{work}/gold")
    days = spark.read.parquet(f"{silver}/{S.PBJ}")
    write_dataset(days.withColumn(S.CENSUS, F.col(S.CENSUS) + 1), f"{work}/silver/{S.PBJ}")
    write_dataset(spark.read.parquet(f"{silver}/{S.PROVIDER}"), f"{work}/silver/{S.PROVIDER}")
    M.run_gold(spark, f"{work}/silver", f"{work}/gold", months=[(1995, 3)])
    return read_gold(spark, f"{work}/gold", "staffing_metrics")


# --- a lake that follows its raw folder ----------------------------------------

def _named_files(spark, df, folder, names):
    """One headered CSV file for each name, from the rows whose ``file`` is its place; replaces files of those names.

    Many rows are written in parts, by several tasks; all of them go into the file.
    """
    made = scratch_path(spark, "named")
    write_dataset(df.repartition("file"), made, fmt="csv", partition_by=["file"])
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(folder))
    for place, name in enumerate(names):
        found = [f.getPath() for f in system.globStatus(path(f"{made}/file={place}/part-*"))]
        system.delete(path(f"{folder}/{name}"), False)
        if len(found) == 1:
            system.rename(found[0], path(f"{folder}/{name}"))
        elif found:
            _join_parts(spark, system, found, path(f"{folder}/{name}"))


def _join_parts(spark, system, parts, target):
    """Move the rows of headered parts into one file, below the header of the first."""
    settings = spark._jsc.hadoopConfiguration()
    out = system.create(target, True)
    try:
        for number, part in enumerate(parts):
            lines = system.open(part)
            try:
                if number:
                    lines.readLine()  # the header again
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(lines, out, settings, False)
            finally:
                lines.close()
            system.delete(part, False)
    finally:
        out.close()


def _third(column):
    return F.dayofmonth(column) % 3


def _days_in_files(spark, sf_dir, corrected):
    """The days in three files: up to 1999, of 2000 and from 2001 on. The second is corrected: census one more, and
    facilities with a number that ends in 3 moved to another state."""
    days = V.pbj(spark, sf_dir).withColumn("file", F.least(F.greatest(F.year(S.WORK_DATE) - 1999, F.lit(0)), F.lit(2)))
    if corrected:
        second = F.col("file") == 1
        days = days.withColumns({
            S.CENSUS: F.when(second, F.col(S.CENSUS) + 1).otherwise(F.col(S.CENSUS)),
            "STATE": F.when(second & F.col("PROVNUM").endswith("3"), "MOVED").otherwise(F.col("STATE"))})
    return days.withColumn(S.WORK_DATE, F.date_format(S.WORK_DATE, "yyyyMMdd"))


_LAKES = {}


def _changed_lake(spark, sf_dir):
    """A lake after three refreshes: two files of days, a run that fails, then a new and a corrected file; made once.

    Returns its folder and what the run that failed was told.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        work = scratch_path(spark, "following")
        raw, lake = f"{work}/raw", f"{work}/lake"
        days = _days_in_files(spark, sf_dir, corrected=False)
        _named_files(spark, days.where("file < 2"), f"{raw}/{S.PBJ}", ["0.csv", "1.csv", "2.csv"])
        providers = V.provider_file(spark, sf_dir).withColumn("file", F.lit(0))
        _named_files(spark, providers, f"{raw}/{S.PROVIDER}", ["all.csv"])
        L.refresh(spark, raw, lake)
        _named_files(spark, _days_in_files(spark, sf_dir, corrected=True).where("file > 0"), f"{raw}/{S.PBJ}",
                     ["none.csv", "1.csv", "2.csv"])
        _named_files(spark, providers.drop("Staffing Rating"), f"{raw}/{S.PROVIDER}", ["all.csv"])
        told = ""
        try:
            L.refresh(spark, raw, lake)
        except ValueError as error:
            told = str(error).split(";")[0]
        _named_files(spark, providers, f"{raw}/{S.PROVIDER}", ["all.csv"])
        L.refresh(spark, raw, lake)
        _LAKES[key] = lake, told
    return _LAKES[key]


@query
def lake_staffing(spark, sf_dir):
    """Staffing after a new day file, a corrected one and facilities that moved: equal to one run over the last files."""
    return L.read_lake(spark, _changed_lake(spark, sf_dir)[0], "staffing_metrics")


@query
def lake_facility(spark, sf_dir):
    return L.read_lake(spark, _changed_lake(spark, sf_dir)[0], "facility_metrics")


@query
def lake_volume(spark, sf_dir):
    return L.read_lake(spark, _changed_lake(spark, sf_dir)[0], "top_patient_volume")


@query
def lake_before_the_change(spark, sf_dir):
    """Staffing of the first version, as it stood when the run after it failed, and what that run was told."""
    lake, told = _changed_lake(spark, sf_dir)
    return L.read_lake(spark, lake, "staffing_metrics", version=1).withColumn("told", F.lit(told))


@query
def manifest_changes(spark, sf_dir):
    """Files of each extract that are new, rewritten or gone between two listings, with the bytes of the days left out."""
    work = scratch_path(spark, "listings")
    extracts = {S.PBJ: V.pbj(spark, sf_dir).withColumn("file", _third(S.WORK_DATE)),
                S.PROVIDER: V.provider_file(spark, sf_dir).withColumn("file", F.lit(0))}
    for name, key, label in ((S.SURVEY_DATES, "o_orderkey", "Survey Number"), (S.STATE_AVERAGES, "c_custkey", "State")):
        source = V.table(spark, sf_dir, "orders" if key == "o_orderkey" else "customer")
        extracts[name] = source.select(F.col(key).alias(label), (F.col(key) % 3).cast("int").alias("file"))
    names = ["0.csv", "1.csv", "2.csv"]
    for name, rows in extracts.items():
        _named_files(spark, rows.where("file < 2"), f"{work}/{name}", names)
    listing = file_manifest(spark, work)
    listing.write.parquet(f"{work}-before")
    before = spark.read.parquet(f"{work}-before")
    for name, rows in extracts.items():  # the first file gone, the second rewritten, the third new
        _named_files(spark, rows.where("file > 0").unionByName(rows.where("file = 1")), f"{work}/{name}", names)
    changes = files.manifest_changes(before, file_manifest(spark, work))
    dataset = F.element_at(F.split("relative_path", "/"), 1)
    return changes.select(
        dataset.alias("dataset"), F.element_at(F.split("relative_path", "/"), 2).alias("file_name"), "change",
        F.when(dataset.isin(S.SURVEY_DATES, S.STATE_AVERAGES), F.coalesce("new_length", F.lit(0)) - F.coalesce(
            "old_length", F.lit(0))).alias("more_bytes"))


@query
def rewritten_file(spark, sf_dir):
    """Bronze after a file was rewritten under its own name: its new rows only, beside those of a file left alone."""
    work = scratch_path(spark, "rewritten")
    names = ["0.csv", "1.csv"]
    orders = V.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("number"), F.col("o_orderpriority").alias("said"), (F.col("o_orderkey") % 2).cast("int").alias("file"))
    _named_files(spark, orders, f"{work}/raw", names)
    incremental_bronze(spark, f"{work}/raw", f"{work}/bronze", f"{work}/progress")
    again = orders.where("file = 1 and number % 3 != 0").withColumn("said", F.lit("anew"))
    _named_files(spark, again, f"{work}/raw", ["none.csv", "1.csv"])
    incremental_bronze(spark, f"{work}/raw", f"{work}/bronze", f"{work}/progress")
    return incremental_bronze(spark, f"{work}/raw", f"{work}/bronze", f"{work}/progress").drop(*S.LANDING_COLUMNS)


def _two_layouts(spark, sf_dir):
    """Orders in two files of one layout and a third with another order of columns and one more."""
    raw = scratch_path(spark, "layouts")
    orders = V.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("number"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
        (F.col("o_orderkey") % 3).cast("int").alias("file"))
    _named_files(spark, orders.where("file < 2").drop("priority"), raw, ["a.csv", "b.csv"])
    turned = orders.where("file = 2").select("priority", "status", "number", F.lit(0).alias("file"))
    _named_files(spark, turned, raw, ["c.csv"])
    return raw


@query
def columns_by_name(spark, sf_dir):
    """Files whose columns come in another order, and one more, as one table."""
    return files.read_layouts(spark, _two_layouts(spark, sf_dir)).select("number", "status", "priority", S.SOURCE_FILE)


@query
def layouts(spark, sf_dir):
    """Layouts of a folder, how many files have each, and the places of their columns."""
    return files.layout_report(spark, _two_layouts(spark, sf_dir))


@query
def large_totals(spark, sf_dir):
    """Sums and means past any long of millionths; one group holds a NaN, which spoils its figures for all to see."""
    first = (F.col("l_orderkey") == 1) & (F.col("l_linenumber") == 1)
    value = F.when(first, float("nan")).otherwise(F.round(F.col("l_extendedprice") * 1e7))
    lines = V.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", value.alias("value"))
    made = lines.groupBy("l_returnflag", "l_linestatus").agg(exact_sum("value").alias("total"), exact_mean("value").alias("mean"))
    spoiled = F.isnan("total") & F.isnan("mean")
    return made.withColumn("spoiled", spoiled).withColumns(
        {c: F.when(~F.isnan(c), F.col(c)) for c in ("total", "mean")})


@query
def preview_staffing(spark, sf_dir):
    keys = [*S.FACILITY_KEYS, *G.MONTH_KEYS]
    return catalog.preview(V.staffing(spark, sf_dir), order_by=keys)


@query
def preview_facility(spark, sf_dir):
    return catalog.preview(V.facility(spark, sf_dir), order_by=["PROVNUM"])


@query
def preview_quality(spark, sf_dir):
    return catalog.preview(V.quality(spark, sf_dir), order_by=["PROVNUM"])


@query
def preview_volume(spark, sf_dir):
    return catalog.preview(top_patient_volume(spark, sf_dir), order_by=["PROVNUM"])
