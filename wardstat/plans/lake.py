"""A lake that is brought up to date with its raw folder, one published version at a time.

Bronze and silver are partitioned by the raw file that their rows come from, gold
by state and month. A refresh lists the raw folder, compares the listing with that
of the last version, lands what is new or rewritten, leaves out what is gone or has
a newer version, finds the months and states that those rows touch, and makes only
their gold partitions anew. Then all layers are published together.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstat import schemas as S
from wardstat.operators.columns import require_columns
from wardstat.plans import gold as G
from wardstat.plans.medallion import ROLLUP, SILVER_STEPS
from wardstat.sources.files import CSV_FILES, file_manifest, manifest_changes, read_layouts
from wardstat.sources.sinks import write_dataset
from wardstat.sources.versions import Run, live, read_entries, read_published, values, without

#: The partition column of silver: the raw file below the raw folder.
FROM_FILE = "from_file"
BRONZE, SILVER, GOLD = "bronze", "silver", "gold"

_NUMBERS = ("TOTAL_NURSE_HOURS", "AVG_PATIENT_CENSUS", *(f"{s}_HOURS" for s in S.STAFF_TYPES), "EMPLOYEE_HOURS",
            "CONTRACT_HOURS", G.CENSUS_DAYS)
ROLLUP_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in S.FACILITY_KEYS] + [T.StructField(c, T.DoubleType()) for c in _NUMBERS]
    + [T.StructField(c, T.IntegerType()) for c in G.MONTH_KEYS])


def dataset_of(relative_path):
    """The extract that a raw file belongs to: its first folder, or its name without suffix."""
    first, _, rest = relative_path.partition("/")
    return first if rest else first[:-4]


def _month(partition):
    held = values(partition)
    return tuple(None if held[k] is None else int(held[k]) for k in G.MONTH_KEYS)


class _Refresh(Run):
    """The steps of one refresh; ``entries`` is what its version will say."""

    def __init__(self, spark, raw_dir, lake_dir, pattern):
        super().__init__(spark, lake_dir)
        self.raw_dir = raw_dir
        self.entries = list(self.before)
        listing = file_manifest(spark, raw_dir, pattern).select("relative_path", "length", "modification_time")
        held = [(e.relative_path, e.length, e.modification_time) for e in live(self.before) if e.relative_path is not None]
        changes = manifest_changes(spark.createDataFrame(held, listing.schema), listing)
        self.changes = [c for c in changes.collect() if dataset_of(c.relative_path) in SILVER_STEPS]

    def _replace(self, table, gone, partitions):
        """Take a table's entries out for which ``gone`` holds, and put new partitions in."""
        self.entries = without(self.entries, lambda e: e.table == table and gone(e))
        self.entries += [self.entry(table, p) for p in partitions]

    def read(self, table, schema=None, entries=None):
        return read_entries(self.spark, self.root, table, self.entries if entries is None else entries, schema)

    def land(self, dataset):
        """Bronze and silver of the raw files of one extract that are new or rewritten."""
        mine = [c for c in self.changes if dataset_of(c.relative_path) == dataset]
        paths = [c.relative_path for c in mine if c.change != "gone"]
        changed = {c.relative_path for c in mine}
        for layer in (BRONZE, SILVER):
            self._replace(f"{layer}/{dataset}", lambda e: values(e.partition or "").get(FROM_FILE, e.relative_path) in changed, [])
        bronze = read_layouts(self.spark, self.raw_dir, paths=paths, unfit=S.UNFIT_ROW) if paths else None
        held = {}
        if bronze is not None:
            held = self._written(dataset, bronze.withColumn(FROM_FILE, F.col(S.SOURCE_FILE)))
        # A file's version is that of the listing: rewritten since, it is landed again next time.
        self.entries += [
            self.entry(f"{BRONZE}/{dataset}", held.get(c.relative_path), c.relative_path, c.new_length, c.new_modification_time)
            for c in mine if c.change != "gone"]

    def _written(self, dataset, bronze):
        """Write bronze and silver rows; the bronze partition of each file that has rows."""
        write_dataset(bronze, self.path(f"{BRONZE}/{dataset}"), partition_by=[FROM_FILE])
        landed = self.spark.read.schema(bronze.schema).parquet(self.path(f"{BRONZE}/{dataset}"))
        silver = SILVER_STEPS[dataset](landed)
        write_dataset(silver, self.path(f"{SILVER}/{dataset}"), partition_by=[FROM_FILE])
        self._replace(f"{SILVER}/{dataset}", lambda e: False, self.partitions(f"{SILVER}/{dataset}", silver.schema))
        return {values(p)[FROM_FILE]: p for p in self.partitions(f"{BRONZE}/{dataset}", landed.schema)}

    def touched(self):
        """The states and months of staffing days that came, went or changed."""
        table = f"{SILVER}/{S.PBJ}"
        changed = {c.relative_path for c in self.changes}
        found = set()
        for side in (self.before, self.entries):
            some = without(side, lambda e: values(e.partition or "").get(FROM_FILE) not in changed)
            if live(some, table):  # a row for each state and month
                found |= {tuple(r) for r in self.read(table, entries=some).select(
                    "STATE", F.year(S.WORK_DATE), F.month(S.WORK_DATE)).distinct().collect()}
        return found

    def rollup(self):
        """Make the roll-up of the touched months anew; the touched states and months."""
        touched, table = self.touched(), f"{GOLD}/{ROLLUP}"
        days = self.read(f"{SILVER}/{S.PBJ}")
        if not touched:
            return touched
        if not days.columns:  # no file is left
            self._replace(table, lambda e: True, [])
            return touched
        require_columns(days, [*S.FACILITY_KEYS, S.WORK_DATE, *S.PBJ_NUMBERS])
        months = {p[1:] for p in touched}
        wanted = self.spark.createDataFrame(sorted(months, key=str), "YEAR int, MONTH int")
        rows = G.monthly_rollup(G.gathered_days(_alike(G.prepare_daily(days), wanted)))
        write_dataset(rows, self.path(table), partition_by=G.MONTH_KEYS)
        self._replace(table, lambda e: _month(e.partition) in months, self.partitions(table, ROLLUP_SCHEMA))
        return touched

    def staffing(self, touched):
        """The staffing partitions of the touched states and months."""
        def gone(entry):
            return (values(entry.partition)["STATE"], *_month(entry.partition)) in touched

        rollup = self.read(f"{GOLD}/{ROLLUP}", ROLLUP_SCHEMA, [e for e in self.entries if e.run == self.id])
        pairs = self.spark.createDataFrame(sorted(touched, key=str), "STATE string, YEAR int, MONTH int")
        self._write("staffing_metrics", _alike(G.staffing_metrics(rollup), pairs), gone)

    def _write(self, name, df, gone=lambda e: True):
        table = f"{GOLD}/{name}"
        schema, partitions = S.GOLD_SCHEMAS[name], S.GOLD_PARTITIONS[name]
        write_dataset(df.select(*schema.names), self.path(table), partition_by=partitions, single_file=not partitions)
        self._replace(table, gone, self.partitions(table, schema))

    def gold(self):
        """The tables over all months, from the roll-up, and those of the providers."""
        rollup = self.read(f"{GOLD}/{ROLLUP}", ROLLUP_SCHEMA)
        raw = self.read(f"{SILVER}/{S.PROVIDER}")
        if raw.columns:
            providers = G.unique_providers(G.provider_model(raw.drop(FROM_FILE)))
            ratios = G.facility_mean_ratio(G.staffing_metrics(rollup))
            self._write("facility_metrics", G.facility_metrics(providers, ratios))
            self._write("quality_metrics", G.quality_metrics(providers))
        else:  # no file of providers is left
            for name in ("facility_metrics", "quality_metrics"):
                self._replace(f"{GOLD}/{name}", lambda e: True, [])
        volume = G.patient_volume(rollup, census=G.CENSUS_DAYS)
        self._write("top_patient_volume", G.top_patient_volume(volume))


def _alike(rows, keys):
    """The rows whose columns are those of a row of ``keys``, nulls alike."""
    return rows.join(keys, [rows[c].eqNullSafe(keys[c]) for c in keys.columns], "left_semi")


def refresh(spark, raw_dir, lake_dir, pattern=CSV_FILES):
    """Bring the lake up to date with its raw folder; returns the number of the published version.

    Raw files lie in a folder for each extract, or are named after one; others are
    left out. A file that was rewritten under its own name counts with its new
    rows, one that is gone no longer counts. Months and states that no changed row
    touches keep their partitions, and their files, from earlier runs; one that
    loses its last row disappears. A refresh that fails publishes nothing: all
    tables read as before, and the next call starts over. Without a change nothing
    is written.

    The changes of the listing, and one row for each touched month and state, come
    to the driver.
    """
    run = _Refresh(spark, raw_dir, lake_dir, pattern)
    if not run.changes:
        return run.version
    changed = {dataset_of(c.relative_path) for c in run.changes}
    for dataset in changed:
        run.land(dataset)
    touched = run.rollup() if S.PBJ in changed else set()
    if changed & {S.PBJ, S.PROVIDER}:
        run.gold()
    if touched:
        run.staffing(touched)
    return run.publish(run.entries)


def read_lake(spark, lake_dir, table, version=None):
    """A gold table of the newest version, or of an earlier one."""
    return read_published(spark, lake_dir, f"{GOLD}/{table}", S.GOLD_SCHEMAS[table], version)


def read_silver(spark, lake_dir, dataset, version=None):
    """A silver table of the newest version, or of an earlier one, without the raw file's name."""
    return read_published(spark, lake_dir, f"{SILVER}/{dataset}", version=version).drop(FROM_FILE)
