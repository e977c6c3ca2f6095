"""Catalog databases, tables, views and previews."""

from wardstat.functions.names import column, quoted
from wardstat.schemas import GOLD_TABLES
from wardstat.sources.files import read_gold
from wardstat.sources.sinks import gathered

# The columns serving asks of the facility table, in its order.
FACILITY_VIEW = (
    "provnum", "provname", "certified_beds", "avg_residents", "overall_rating",
    "health_rating", "staffing_rating", "occupancy_rate", "avg_staffing_ratio",
    "staffing_pressure_index", "state",
)


def create_database(spark, name, location=None):
    where = "" if location is None else " LOCATION '{}'".format(
        location.replace("\\", "\\\\").replace("'", "\\'"))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}{where}")
    return name


def save_table(df, name, partition_by=()):
    """Replace a managed table, its schema included."""
    if partition_by:
        df = gathered(df, partition_by)
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return name


def read_table(spark, name):
    return spark.table(name)


def select_all(spark, name):
    return spark.table(name).select("*")


def select_columns(spark, name, columns=FACILITY_VIEW):
    """Named columns only, so that the scan reads no others."""
    return spark.table(name).select(*[column(c) for c in columns])


def preview(df, n=10, order_by=()):
    """``n`` rows. Give a total order for a repeatable choice; without one Spark
    stops at the first rows it finds."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def register_gold(spark, gold_dir, fmt="parquet"):
    """Temporary views over the gold tables, named as the tables."""
    for table in GOLD_TABLES:
        read_gold(spark, gold_dir, table, fmt).createOrReplaceTempView(table)
    return GOLD_TABLES
