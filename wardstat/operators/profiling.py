"""Null counts, duplicates and deduplication."""

from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstat.functions.names import column, quoted

#: Types whose null counts Parquet footers hold and Spark reads there.
COUNTED = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


def null_counts(df):
    """One row: the number of nulls in every column.

    Written as a difference of counts, which is 0 on empty input and which a
    columnar source may answer from file statistics.
    """
    total = F.count(F.lit(1))
    return df.agg(*[(total - F.count(column(c))).alias(c) for c in df.columns])


@contextmanager
def _settings(spark, values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def footer_counts(spark, path, names):
    """The plan that counts rows and values of plain columns by the footers of Parquet files; run it under the settings
    of ``null_counts_of_files``."""
    df = spark.read.parquet(path)
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(column(c)).alias(f"c{i}") for i, c in enumerate(names)])


def null_counts_of_files(spark, path):
    """``null_counts`` of Parquet files, one row, without a scan of the columns that the files' footers answer for.

    Columns of nested types are scanned, and so are all if a file was written
    without statistics. Runs at once: one row of counts comes to the driver.
    """
    schema = spark.read.parquet(path).schema
    plain = [f.name for f in schema if isinstance(f.dataType, COUNTED)]
    footers = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    try:
        with _settings(spark, footers):
            counted = footer_counts(spark, path, plain).first()
    except (PySparkException, Py4JJavaError):  # no statistics
        plain, counted = [], None
    nulls = {c: counted.rows - counted[f"c{i}"] for i, c in enumerate(plain)}
    rest = [f.name for f in schema if f.name not in nulls]
    if rest:
        row = null_counts(spark.read.parquet(path).select(*[column(c) for c in rest])).first()
        nulls |= dict(zip(rest, row))
    kind = T.StructType([T.StructField(f.name, T.LongType()) for f in schema])
    return spark.createDataFrame([tuple(nulls[f.name] for f in schema)], kind)


def null_summary(df):
    """``column_name, null_count``, one row per column, in one pass."""
    return null_counts(df).unpivot([], [quoted(c) for c in df.columns], "column_name", "null_count")


def most_nulls_first(summary):
    return summary.orderBy(F.desc("null_count"), "column_name")


def nulls_by_column(summary):
    """Dashboard measure: nulls per column name over one or more summaries."""
    return summary.groupBy("column_name").agg(F.sum("null_count").alias("null_count"))


def row_count(df):
    """Dashboard measure: number of rows."""
    return df.agg(F.count(F.lit(1)).alias("count"))


def duplicate_rows(df, count_name="dup_count"):
    """The distinct rows that occur more than once, with how often.

    Equal rows are counted before the shuffle, so a row that makes up a third
    of the table sends one record per task.
    """
    if count_name.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"column {count_name!r} exists; choose another count_name")
    counted = df.groupBy(*[column(c) for c in df.columns])
    return counted.agg(F.count(F.lit(1)).alias(count_name)).filter(F.col(count_name) > 1)


def _digested(df):
    """The table with two hashes of each row in one struct column, and that column's name; None if a type has no hash."""
    if any("map<" in kind or "variant" in kind for _, kind in df.dtypes):
        return None, None
    name = "_row"
    while name in {c.lower() for c in df.columns}:
        name = f"_{name}"
    cells = [column(c) for c in df.columns]
    return df.withColumn(name, F.struct(F.xxhash64(*cells).alias("a"), F.xxhash64(F.lit(1), *cells).alias("b"))), name


def duplicate_rows_by_digest(df, count_name="dup_count"):
    """``duplicate_rows`` for wide rows: digests of 16 bytes are counted first.

    Only rows whose digest occurs more than once are then compared in all their
    columns, so equal digests of different rows do no harm. Null cells are alike,
    as in any grouping. A digest leaves nulls out: rows that differ only in which
    cells are null are among those that are compared.
    """
    rows, name = _digested(df)
    if rows is None:
        return duplicate_rows(df, count_name)
    twice = rows.groupBy(name).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(name)
    return duplicate_rows(rows.join(twice, name, "left_semi").drop(name), count_name)


def drop_exact_duplicates(df):
    return df.dropDuplicates()


def first_row_per_key(df, keys):
    """One row per key: the smallest in column order, nulls first.

    ``min`` of a struct compares field by field, so the survivor is the same on
    every run. It is reduced before the shuffle: a hot key sends one row per
    task instead of passing whole through one window.
    """
    others = [c for c in df.columns if c not in set(keys)]
    if not others:
        return df.dropDuplicates()
    smallest = F.min(F.struct(*[column(c) for c in others])).alias("_first")
    picked = df.groupBy(*[column(k) for k in keys]).agg(smallest)
    return picked.select(*[
        column(c) if c in set(keys) else F.col(f"_first.{quoted(c)}").alias(c)
        for c in df.columns
    ])
