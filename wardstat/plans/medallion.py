"""Raw files to bronze, silver and gold. Each layer is a directory of datasets."""

from datetime import date
from functools import reduce
from operator import or_

from pyspark import StorageLevel
from pyspark.sql import functions as F

from wardstat import schemas as S
from wardstat.operators.columns import (
    apply_types,
    drop_if_present,
    require_columns,
    sanitize_columns,
)
from wardstat.operators.profiling import most_nulls_first, null_summary
from wardstat.plans import gold as G
from wardstat.sources.catalog import save_table
from wardstat.sources.files import layouts, literal_path, read_csv, with_lineage
from wardstat.sources.sinks import write_dataset


ROLLUP = "monthly_rollup"


def _under(root, name):
    return f"{root.rstrip('/')}/{name}"


def dataset_name(relative_path):
    """A file's path less its suffix as one folder name, so that no data set lies in another's."""
    stem = relative_path[:-4] if relative_path.lower().endswith(".csv") else relative_path
    return stem.replace("~", "~0").replace("/", "~1")


def landed_datasets(spark, raw_dir):
    """The CSV files found, grouped by header: name of the first file -> paths.

    Files of one layout are one data set, landed by one job. The files' first
    lines are found in one pass; their paths come to the driver, nothing else.
    Pass ``run_bronze`` globs, one per data set, to save the pass. An empty file
    has no header and is left out.
    """
    return {dataset_name(paths[0]): [literal_path(p) for p in paths] for paths in layouts(spark, raw_dir)}


def load_bronze(spark, raw_dir, paths=None):
    """Raw files of one layout, ``raw_dir`` itself or paths below it: all text, with lineage columns.

    A row that does not fit the header is kept whole in a column of its own.
    """
    found = [paths] if isinstance(paths, str) else paths
    where = raw_dir if paths is None else [_under(raw_dir, p) for p in found]
    return with_lineage(read_csv(spark, where, unfit=S.UNFIT_ROW), raw_dir)


def run_bronze(spark, raw_dir, bronze_dir, datasets=None):
    """Land every CSV file of ``raw_dir``; returns the loaded rows per file.

    ``datasets`` maps a dataset name to a path or glob below ``raw_dir``, or a list
    of them; by default the files are grouped by header, see ``landed_datasets``.
    """
    datasets = landed_datasets(spark, raw_dir) if datasets is None else datasets
    for name, pattern in datasets.items():
        write_dataset(load_bronze(spark, raw_dir, pattern), _under(bronze_dir, name))
    return bronze_report(spark, bronze_dir, datasets)


def bronze_report(spark, bronze_dir, names):
    """``dataset, source_file, row_count``; reads the file-name column only."""
    parts = [
        spark.read.parquet(_under(bronze_dir, literal_path(name)))
        .groupBy(F.col(S.SOURCE_FILE).alias("source_file"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("dataset"), "source_file", "row_count")
        for name in names
    ]
    if not parts:
        return spark.createDataFrame([], "dataset string, source_file string, row_count bigint")
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def silver_support(bronze):
    """Provider, state average and survey tables: less the dropped columns."""
    return drop_if_present(bronze, (*S.SILVER_DROPPED, *S.LANDING_COLUMNS))


def silver_provider(bronze):
    return apply_types(silver_support(bronze), numbers=S.PROVIDER_NUMBERS)


def silver_pbj(bronze):
    """Daily staffing keeps every column; the ones gold reads are typed."""
    kept = drop_if_present(bronze, S.LANDING_COLUMNS)
    return apply_types(kept, numbers=S.PBJ_NUMBERS, dates=(S.WORK_DATE,))


SILVER_STEPS = {
    S.PROVIDER: silver_provider,
    S.STATE_AVERAGES: silver_support,
    S.SURVEY_DATES: silver_support,
    S.PBJ: silver_pbj,
}


def run_silver(spark, bronze_dir, silver_dir, steps=None, fmt="parquet"):
    for name, step in (SILVER_STEPS if steps is None else steps).items():
        bronze = spark.read.parquet(_under(bronze_dir, name))
        write_dataset(step(bronze), _under(silver_dir, name), fmt=fmt)


def write_gold(df, gold_dir, table, fmt="parquet", replace_partitions_only=False):
    return write_dataset(
        df.select(*S.GOLD_SCHEMAS[table].names), _under(gold_dir, table), fmt=fmt,
        partition_by=S.GOLD_PARTITIONS[table],
        replace_partitions_only=replace_partitions_only,
        single_file=not S.GOLD_PARTITIONS[table])


def _of_months(column, months):
    """Days of any of the ``(year, month)`` pairs, as ranges that a scan can be filtered by."""
    chosen = F.lit(False)
    for year, month in months:
        after = date(year + month // 12, month % 12 + 1, 1)
        chosen = chosen | ((F.col(column) >= F.lit(date(year, month, 1))) & (F.col(column) < F.lit(after)))
    return chosen


def run_gold(spark, silver_dir, gold_dir, fmt="parquet", months=None):
    """Write the four gold tables.

    The days are scanned once, in any order: their monthly roll-up is written beside the gold
    tables and feeds staffing, facility and volume. The deduplicated providers
    are kept for the two tables that use them; a lost executor only means that
    its part is computed again.

    With ``months``, pairs of year and month, only their days are read; their
    partitions of the roll-up and of the staffing table are replaced and all
    others left alone. The tables over all months are made from the roll-up.
    """
    pbj = spark.read.parquet(_under(silver_dir, S.PBJ))
    require_columns(pbj, [*S.FACILITY_KEYS, S.WORK_DATE, *S.PBJ_NUMBERS])
    if months is not None:
        pbj = pbj.where(_of_months(S.WORK_DATE, months))
    rollup_path = _under(gold_dir, ROLLUP)
    write_dataset(G.monthly_rollup(G.prepare_daily(G.gathered_days(pbj))), rollup_path, partition_by=G.MONTH_KEYS,
                  replace_partitions_only=months is not None)
    rollup = spark.read.parquet(rollup_path)
    staffing = G.staffing_metrics(rollup)
    fresh = staffing
    if months is not None:
        fresh = staffing.where(reduce(or_, [
            (F.col("YEAR") == y) & (F.col("MONTH") == m) for y, m in months], F.lit(False)))

    raw = spark.read.parquet(_under(silver_dir, S.PROVIDER))
    providers = G.unique_providers(G.provider_model(raw)).persist(StorageLevel.DISK_ONLY)
    try:
        write_gold(fresh, gold_dir, "staffing_metrics", fmt, replace_partitions_only=months is not None)
        ratios = G.facility_mean_ratio(staffing)
        write_gold(G.facility_metrics(providers, ratios), gold_dir, "facility_metrics", fmt)
        volume = G.patient_volume(rollup, census=G.CENSUS_DAYS)
        write_gold(G.top_patient_volume(volume), gold_dir, "top_patient_volume", fmt)
        write_gold(G.quality_metrics(providers), gold_dir, "quality_metrics", fmt)
    finally:
        providers.unpersist()
    return gold_dir


def run_all(spark, raw_dir, lake_dir, datasets=None):
    """Raw to gold below ``lake_dir``; returns the gold directory."""
    bronze, silver, gold = (_under(lake_dir, n) for n in ("bronze", "silver", "gold"))
    run_bronze(spark, raw_dir, bronze, datasets)
    run_silver(spark, bronze, silver)
    return run_gold(spark, silver, gold)


def profile_table(df, table, summary_table):
    """Save ``df`` under clean names and its null summary beside it; returns the
    summary, columns with most nulls first."""
    spark = df.sparkSession
    save_table(sanitize_columns(df), table)
    save_table(null_summary(spark.table(table)), summary_table)
    return most_nulls_first(spark.table(summary_table))
