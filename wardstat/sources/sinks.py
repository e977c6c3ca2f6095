"""Dataset writers."""

# A quote inside a quoted cell is written twice and read back as one.
CSV_OPTIONS = {"header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"'}

def gathered(df, partition_by):
    """Rows of one partition brought together, hot partitions split.

    Without adaptive execution the hint would be ignored; rows are then simply
    hashed by the partition columns.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled").strip().lower() == "true":
        return df.hint("rebalance", *partition_by)
    return df.repartition(*partition_by)


def write_dataset(df, path, fmt="parquet", partition_by=(), mode="overwrite",
                  replace_partitions_only=False, single_file=False):
    """Write a directory of files.

    Partitioned writes are rebalanced by the partition columns first: one state
    and month lands in one file instead of one per task, while adaptive
    execution splits a partition that is too large for one task. With
    ``replace_partitions_only`` partitions without new rows are left alone.
    ``single_file`` is for results of a few rows only. CSV cannot tell an empty
    text from a null; use Parquet between layers.
    """
    if partition_by:
        df = gathered(df, partition_by)
    elif single_file:
        df = df.coalesce(1)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        overwrite = "dynamic" if replace_partitions_only else "static"
        writer = writer.option("partitionOverwriteMode", overwrite)
    writer.save(path)
    return path
