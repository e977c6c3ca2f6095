"""Runs that write beside each other, and small manifests that say which partitions count.

A run writes its tables below a folder of its own. When all of them are there it
publishes one version: a list of every table's partitions and the run that holds
each. Readers take the newest version and read the folders that it names, so a
run that fails on the way changes nothing for them, and a run may replace some
partitions and leave the others where they are. Nothing is written twice or
removed; runs that no version names any more can be deleted at leisure.
"""

from __future__ import annotations

import posixpath
import uuid
from collections import defaultdict, namedtuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstat.sources.files import literal_path

PUBLISHED = "published"
RUNS = "runs"
#: The folder of a partition's null.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: One row for each partition of a table; partition "" is a table without any, null holds no rows.
#: Raw files that a run landed also have their path, length and time of change. A partition that no
#: longer counts is listed as not ``live`` as long as its run holds others that do.
ENTRIES = ("table string, partition string, run string, relative_path string, length long, "
           "modification_time timestamp, live boolean")
Entry = namedtuple("Entry", [column.split()[0] for column in ENTRIES.split(", ")])


def values(partition):
    """``YEAR=2024/STATE=TX`` as a dict; a null partition value is None."""
    pairs = (part.split("=", 1) for part in partition.split("/") if part)
    return {unquote(k): None if v == NO_VALUE else unquote(v) for k, v in pairs}


def published(spark, root):
    """The entries of all versions, with ``version`` and ``writer``; None if there is none."""
    path = f"{root.rstrip('/')}/{PUBLISHED}"
    try:
        return spark.read.schema(f"{ENTRIES}, version long, writer string").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return None


def current(spark, root, version=None):
    """The entries of the newest version, or of that given, and its number; ``([], 0)`` if there is none.

    The list is as long as the tables have partitions and the raw folder has
    files. It comes to the driver, which names the folders to read.
    """
    entries = published(spark, root)
    newest = None
    if entries is not None:
        some = entries if version is None else entries.where(F.col("version") == version)
        newest = some.agg(F.max(F.struct("version", "writer")).alias("v")).first().v
    if newest is None:
        return [], 0
    rows = entries.where((F.col("version") == newest.version) & (F.col("writer") == newest.writer))
    return [Entry(*r) for r in rows.select(*Entry._fields).collect()], newest.version


def live(entries, table=None):
    """The entries that count, of one table or of all."""
    return [e for e in entries if e.live and table in (None, e.table)]


def without(entries, gone):
    """The entries, those for which ``gone`` holds no longer live."""
    return [e._replace(live=False) if e.live and gone(e) else e for e in entries]


def folders(live_ones, dead):
    """The fewest folders that hold all live partitions and no dead one."""
    def below(prefix, some, others):
        if not others:
            return [prefix]
        heads = defaultdict(lambda: ([], []))
        for side, partitions in enumerate((some, others)):
            for p in partitions:
                heads[p[len(prefix):].lstrip("/").split("/", 1)[0]][side].append(p)
        return [path for head, (a, b) in sorted(heads.items()) if a for path in below(f"{prefix}/{head}".lstrip("/"), a, b)]

    return below("", list(live_ones), list(dead))


def _by_run(root, table, entries):
    """The table's folder in each run that holds a part of it, and the live and other partitions there."""
    held = defaultdict(lambda: ([], []))
    for entry in entries:
        if entry.table == table and entry.partition is not None:
            held[f"{root.rstrip('/')}/{RUNS}/{entry.run}/{table}"][not entry.live].append(entry.partition)
    return sorted((base, *both) for base, both in held.items() if both[0])


def schema_of(spark, root, table, entries):
    """The columns that a table has in any of its runs, by name; those of partitions are last, as text."""
    fields, last = {}, {}
    for base, partitions, _ in _by_run(root, table, entries):
        names = values(partitions[0])
        for field in spark.read.parquet(base).schema:
            (last if field.name in names else fields).setdefault(field.name, field)
    return T.StructType([*fields.values(), *(T.StructField(name, T.StringType()) for name in last)])


def read_entries(spark, root, table, entries, schema=None):
    """The rows of a table that the live entries name.

    Declare the types of a table with partition columns that are no text. Without
    a schema it is that of ``schema_of``: a column that a run did not write is null
    in its rows.
    """
    schema = schema or schema_of(spark, root, table, entries)
    made = None
    for base, some, others in _by_run(root, table, entries):
        paths = [literal_path(f"{base}/{p}" if p else base) for p in folders(some, others)]
        part = spark.read.schema(schema).option("basePath", base).parquet(*paths)
        made = part if made is None else made.unionByName(part)
    return spark.createDataFrame([], schema) if made is None else made


def read_published(spark, root, table, schema=None, version=None):
    """A table as the newest version has it, or an earlier one."""
    return read_entries(spark, root, table, current(spark, root, version)[0], schema)


class Run:
    """One run below ``root``: where it writes, what held before, and its publishing.

    One run at a time: of two that publish at once the later one counts.
    """

    def __init__(self, spark, root):
        self.spark, self.root, self.id = spark, root.rstrip("/"), uuid.uuid4().hex
        self.before, self.version = current(spark, root)

    def path(self, table):
        return f"{self.root}/{RUNS}/{self.id}/{table}"

    def entry(self, table, partition="", relative_path=None, length=None, modification_time=None):
        return Entry(table, partition, self.id, relative_path, length, modification_time, True)

    def partitions(self, table, schema):
        """The partitions of a table that this run has written, from the list of its files."""
        files = self.spark.read.schema(schema).parquet(self.path(table)).inputFiles()
        anchor = f"/{RUNS}/{self.id}/{table}/"
        return sorted({posixpath.dirname(unquote(f).split(anchor, 1)[1]) for f in files})

    def publish(self, entries):
        """Make the entries the newest version: one file, there as a whole or not at all."""
        used = {(e.table, e.run) for e in entries if e.live}
        rows = self.spark.createDataFrame([tuple(e) for e in entries if (e.table, e.run) in used], ENTRIES)
        rows.coalesce(1).write.parquet(f"{self.root}/{PUBLISHED}/version={self.version + 1}/writer={self.id}")
        return self.version + 1
