"""Top-k lists."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from wardstat.schemas import FACILITY_KEYS


def top_k(df, metric, k=10, ties=FACILITY_KEYS, keep_null=False):
    """The ``k`` largest rows by ``metric``; equal metrics go by ``ties``.

    Sort and limit together become one top-k per task and a merge of at most
    ``k`` rows from each: no full sort.
    """
    rows = df if keep_null else df.dropna(subset=[metric])
    return rows.orderBy(F.desc_nulls_last(metric), *[F.asc(c) for c in ties]).limit(k)


def top_k_of_each(df, metric, group, k=10, ties=FACILITY_KEYS, place="PLACE"):
    """The ``top_k`` of every value of ``group`` at once, with its place in that list; null groups have none.

    Spark keeps at most ``k`` rows of a group in each task before the shuffle, so
    a group with a third of all rows sends few.
    """
    order = Window.partitionBy(group).orderBy(F.desc_nulls_last(metric), *[F.asc(c) for c in ties])
    rows = df.dropna(subset=[metric, group])
    return rows.withColumn(place, F.row_number().over(order)).where(F.col(place) <= k)
