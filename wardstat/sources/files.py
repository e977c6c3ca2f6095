"""File listings, headered CSV and Parquet datasets."""

import posixpath
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstat.schemas import GOLD_SCHEMAS, INGESTED_AT, MODIFIED_AT, SOURCE_FILE
from wardstat.sources.sinks import CSV_OPTIONS

# Globs know no case of their own.
CSV_FILES = "*.[cC][sS][vV]"


def file_manifest(spark, root, pattern=CSV_FILES):
    """One row per file below ``root``: relative path, name, length, time.

    Only file metadata is read: the content column is never requested. The
    listing is complete, however many files there are.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    return listed.select(
        _relative(F.col("path"), root).alias("relative_path"),
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length"),
        F.col("modificationTime").alias("modification_time"),
    )


def manifest_changes(before, now):
    """What has happened between two listings: ``relative_path, change`` and length and time of both.

    ``change`` is ``new``, ``gone`` or ``changed``; a file that has the same length
    and time in both is left out. The listings meet by path in one full join.
    """
    old, new = (listing.select("relative_path", *(F.col(c).alias(f"{side}_{c}") for c in ("length", "modification_time")))
                for side, listing in (("old", before), ("new", now)))
    same = (F.col("old_length") == F.col("new_length")) & (F.col("old_modification_time") == F.col("new_modification_time"))
    change = F.when(F.col("old_length").isNull(), "new").when(F.col("new_length").isNull(), "gone").when(~same, "changed")
    return old.join(new, "relative_path", "full").withColumn("change", change).where("change is not null")


def _below(root):
    """The part of a listed path that stands for ``root``, without its scheme."""
    return posixpath.normpath(re.sub(r"^[A-Za-z][\w+.-]*:/*", "/", root)) + "/"


def first_lines(spark, root, pattern=CSV_FILES, paths=None):
    """``relative_path, first_line`` of every file below ``root``, or of the named ones, that has a line."""
    where = root if paths is None else [f"{root.rstrip('/')}/{literal_path(p)}" for p in paths]
    lines = (
        spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(where)
        .select("value", F.col("_metadata.file_path").alias("path"),
                F.col("_metadata.file_block_start").alias("start"),
                F.monotonically_increasing_id().alias("row"))
        .where("start = 0")
    )
    path = _relative(_decoded(F.col("path")), root)
    return lines.groupBy(path.alias("relative_path")).agg(F.min_by("value", "row").alias("first_line"))


def _decoded(path):
    """A listed path without its escapes; a plus sign is itself."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _relative(path, root):
    """A path column below ``root``; the file name alone if it is not below it."""
    anchor = _below(root)
    start = F.locate(anchor, path)
    below = F.substring(path, start + F.lit(len(anchor)), F.lit(2**31 - 1))
    return F.when(start > 0, below).otherwise(F.element_at(F.split(path, "/"), -1))


def layouts(spark, root, pattern=CSV_FILES, paths=None):
    """The files below ``root``, or the named ones, as a list of lists: those of one header together.

    Their paths come to the driver, nothing else. An empty file has no header and
    is left out.
    """
    grouped = first_lines(spark, root, pattern, paths).groupBy("first_line").agg(
        F.sort_array(F.collect_list("relative_path")).alias("paths"))
    return sorted(r.paths for r in grouped.collect())


def read_layouts(spark, root, pattern=CSV_FILES, paths=None, unfit=None):
    """Headered CSV files whose headers differ in order or in columns, as one table with lineage columns.

    Files of one header are read by that header; the layouts meet by name. A
    column that a layout does not have is null in its rows, and the columns of the
    first file come first. None if there is no file with a header.
    """
    made = None
    for group in layouts(spark, root, pattern, paths):
        where = [f"{root.rstrip('/')}/{literal_path(p)}" for p in group]
        part = with_lineage(read_csv(spark, where, unfit=unfit), root)
        made = part if made is None else made.unionByName(part, allowMissingColumns=True)
    return made


def layout_report(spark, root, pattern=CSV_FILES):
    """One row for each layout and column of any: ``layout, n_files, column_name, position``.

    Layouts are numbered from 1 by their first file; ``position`` counts from 1 and
    is null where the layout does not have the column.
    """
    found = [(len(g), read_csv(spark, f"{root.rstrip('/')}/{literal_path(g[0])}").columns) for g in layouts(spark, root, pattern)]
    names = list(dict.fromkeys(name for _, columns in found for name in columns))
    rows = [(number, n, name, columns.index(name) + 1 if name in columns else None)
            for number, (n, columns) in enumerate(found, start=1) for name in names]
    return spark.createDataFrame(rows, "layout int, n_files int, column_name string, position int")


def literal_path(path):
    """The path with glob characters escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def csv_text_schema(spark, path):
    """All columns of a headered CSV as text. Reads one header, runs no
    inference."""
    names = spark.read.options(**CSV_OPTIONS).csv(path).columns
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_csv(spark, path, schema=None, unfit=None, multi_line=False):
    """Headered CSV files or a directory; all text unless a schema is given.

    Every file must carry the header in the same order, with a schema or without:
    a file with other columns is an error instead of a silent mix-up of columns by
    position. Quotes inside quoted cells are doubled. ``multi_line`` allows line
    breaks there, at the price that a file is read by one task.

    A row with missing cells is filled with nulls and one with more cells than the
    header is cut; name a column in ``unfit`` to keep the text of such rows whole.
    """
    schema = schema or csv_text_schema(spark, path)
    if unfit:
        schema = T.StructType([*schema.fields, T.StructField(unfit, T.StringType())])
    return csv_reader(spark.read, schema, unfit, multi_line).csv(path)


def csv_reader(reader, schema, unfit=None, multi_line=False):
    """A batch or stream reader with the options of ``read_csv``."""
    reader = (
        reader.schema(schema).options(**CSV_OPTIONS)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
    )
    return reader.option("columnNameOfCorruptRecord", unfit) if unfit else reader


def with_lineage(df, root):
    """Add the source file's path below ``root``, its time of change and the load time.

    These are made for every row. A root of plain characters stands in the listed
    path as it is: the path is cut first, and only a rest with an escape is decoded.
    """
    path = F.col("_metadata.file_path")
    plain = re.fullmatch(r"[\w./~-]+", _below(root), re.ASCII)
    found = df.select(
        "*",
        _relative(path if plain else _decoded(path), root).alias(SOURCE_FILE),
        F.col("_metadata.file_modification_time").alias(MODIFIED_AT),
    )
    if plain:
        cut = F.col(SOURCE_FILE)
        found = found.withColumn(SOURCE_FILE, F.when(F.contains(cut, F.lit("%")), _decoded(cut)).otherwise(cut))
    return found.withColumn(INGESTED_AT, F.current_timestamp())


def read_gold(spark, gold_dir, table, fmt="parquet"):
    """A gold table with its declared types. Types must be declared for the
    partition columns too: a state code such as ``01`` would become a number."""
    reader = spark.read.schema(GOLD_SCHEMAS[table]).format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS).option("enforceSchema", False)
    return reader.load(f"{gold_dir.rstrip('/')}/{table}")
