"""The bronze load, run so that each version of a raw file is landed exactly once."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstat.schemas import INGESTED_AT, MODIFIED_AT, SOURCE_FILE, UNFIT_ROW
from wardstat.sources.files import (
    CSV_FILES,
    csv_reader,
    csv_text_schema,
    file_manifest,
    manifest_changes,
    with_lineage,
)

# The source would otherwise pass over files a week older than the newest landed.
ANY_AGE = "36500d"
LISTING = "relative_path string, length long, modification_time timestamp"


def latest_versions(bronze, listing=None):
    """The rows of each file's latest version: that of the latest change, of the latest load of it.

    With a listing, rows older than the file's time in it are no version that
    counts: the file has been rewritten without any row since.
    """
    version = F.struct(MODIFIED_AT, INGESTED_AT)
    newest = bronze.groupBy(SOURCE_FILE).agg(F.max(version).alias("_newest"))
    if listing is not None:
        listed = listing.select(F.col("relative_path").alias(SOURCE_FILE), F.col("modification_time").alias("_listed"))
        newest = newest.join(listed, SOURCE_FILE, "left").where(
            F.coalesce(F.col("_listed") <= F.col(f"_newest.{MODIFIED_AT}"), F.lit(True)))
    return bronze.join(newest, SOURCE_FILE).where(version == F.col("_newest")).select(*bronze.columns)


def _listings(bronze_path, name):
    return f"{bronze_path.rstrip('/')}-listings/{name}"


def _last(spark, folder):
    """The newest listing in a folder and its number; ``(None, 0)`` if there is none."""
    try:
        held = spark.read.schema(f"{LISTING}, version int").parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None, 0
    newest = held.agg(F.max("version")).first()[0] or 0
    return held.where(F.col("version") == newest).drop("version"), newest


def _keep(listing, folder, version):
    listing.coalesce(1).write.mode("overwrite").parquet(f"{folder}/version={version}")


def _rewritten(spark, before, now, bronze_path, sure):
    """Files of the listing that are landed in an older version, from the listings or, without them, from bronze."""
    if sure:
        return manifest_changes(before, now).where("change = 'changed'").select("relative_path")
    landed = spark.read.parquet(bronze_path).groupBy(F.col(SOURCE_FILE).alias("relative_path")).agg(
        F.max(MODIFIED_AT).alias("landed_at"))
    return now.join(landed, "relative_path").where("modification_time > landed_at").select("relative_path")


def incremental_bronze(spark, raw_dir, bronze_path, progress_dir, pattern=CSV_FILES, schema=None,
                       files_per_batch=None):
    """Land the files that are new or rewritten since the last call, however old, then stop.

    The stream keeps its list of files done in ``progress_dir`` (a folder all
    executors share) and lands new names. Files rewritten under their own name are
    found by comparing this call's listing with that of the last one and landed
    after it; bronze is not read for that unless the last call broke off. All
    versions stay, in ``bronze_path`` and folders whose names begin so; the rows
    returned are those of ``read_bronze``. A call
    after a crash goes on where the last one stopped: a version that is landed
    twice counts once. A file with another header fails the batch; a file name
    with glob characters is an error. Rows that do not fit the header are kept
    whole in a column of their own. The paths of rewritten files come to the
    driver.
    """
    begun, done = (_listings(bronze_path, name) for name in ("begun", "done"))
    before, version = _last(spark, done)
    sure = before is not None and _last(spark, begun)[1] == version
    _keep(file_manifest(spark, raw_dir, pattern).select("relative_path", "length", "modification_time"), begun, version + 1)
    now = spark.read.schema(LISTING).parquet(f"{begun}/version={version + 1}")

    globs = [r.relative_path for r in now.where(F.col("relative_path").rlike(r"[\[\]{}*?\\]")).limit(10).collect()]
    if globs:  # the stream would take the name for a pattern, and read other files twice
        raise ValueError(f"files with glob characters in their names: {globs}")

    schema = schema or csv_text_schema(spark, f"{raw_dir.rstrip('/')}/{pattern}")
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    schema = T.StructType([*schema.fields, T.StructField(UNFIT_ROW, T.StringType())])
    reader = (
        csv_reader(spark.readStream, schema, UNFIT_ROW)
        .option("pathGlobFilter", pattern)
        .option("maxFileAge", ANY_AGE)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        with_lineage(reader.csv(raw_dir), raw_dir)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", progress_dir)
        .trigger(availableNow=True)
        .start(bronze_path)
    )
    query.awaitTermination()
    changed = [r.relative_path for r in _rewritten(spark, before, now, bronze_path, sure).collect()]
    if changed:
        paths = [f"{raw_dir.rstrip('/')}/{p}" for p in changed]
        again = with_lineage(csv_reader(spark.read, schema, UNFIT_ROW).csv(paths), raw_dir)
        again.write.mode("append").parquet(f"{bronze_path.rstrip('/')}-versions")
    _keep(now, done, version + 1)
    return read_bronze(spark, bronze_path)


def read_bronze(spark, bronze_path):
    """The landed rows of each file's latest version, as of the last call that ended; files that are gone stay."""
    rows = spark.read.parquet(bronze_path)
    try:
        rows = rows.unionByName(spark.read.parquet(f"{bronze_path.rstrip('/')}-versions"), allowMissingColumns=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return latest_versions(rows, _last(spark, _listings(bronze_path, "done"))[0])
