"""Column selection, naming, coercion and checks."""

from pyspark.sql import functions as F

from wardstat.functions.conversions import to_double, to_number, to_work_date
from wardstat.functions.names import column, rename_all, sanitized, standardized


def drop_if_present(df, names):
    """Drop the named columns; names that are absent are ignored."""
    return df.drop(*names)


def sanitize_columns(df):
    return rename_all(df, sanitized)


def standardize_columns(df):
    return rename_all(df, standardized)


def resolve(df, name):
    """The column of ``df`` that carries ``name``, raw or sanitised, in any case."""
    have = {c.lower(): c for c in df.columns}
    for candidate in (name, sanitized(name)):
        if candidate.lower() in have:
            return have[candidate.lower()]
    raise ValueError(f"no column {name!r}; available: {df.columns}")


def select_renamed(df, text=None, numbers=None):
    """Project to a model: ``{source: target}`` maps for text and for doubles."""
    kept = [column(resolve(df, s)).cast("string").alias(t) for s, t in (text or {}).items()]
    cast = [to_double(column(resolve(df, s))).alias(t) for s, t in (numbers or {}).items()]
    return df.select(*kept, *cast)


def apply_types(df, numbers=(), dates=()):
    """Type the named columns; the others pass through unchanged. A name may be
    carried raw or sanitised; names that are absent are ignored."""
    types = {f.name: f.dataType for f in df.schema}
    have = {c.lower(): c for c in df.columns}

    def present(names):
        keys = [(n.lower(), sanitized(n).lower()) for n in names]
        return [have[k] for pair in keys for k in dict.fromkeys(pair) if k in have]

    typed = {c: to_double(column(c)) for c in present(numbers)}
    typed |= {c: to_work_date(column(c), types[c]) for c in present(dates)}
    return df.select(*[typed.get(c, column(c)).alias(c) for c in df.columns])


def coerce_numeric(df, names):
    """Turn the named columns into doubles; what is no number becomes null and
    absent columns are skipped."""
    wanted = set(names)
    return df.select(*[
        to_number(column(f.name), f.dataType).alias(f.name) if f.name in wanted else column(f.name)
        for f in df.schema
    ])


def require_columns(df, names):
    """Return ``df`` or fail, naming the missing and the available columns."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}; available columns: {df.columns}")
    return df


def schema_report(df):
    """One row per column: ordinal, name and type. Reads no data."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema, start=1)]
    return df.sparkSession.createDataFrame(
        rows, "ordinal int, column_name string, data_type string")


def column_profile(df):
    """The schema report with the null count of each column, in one pass."""
    entries = [
        F.struct(
            F.lit(i).alias("ordinal"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            (F.count(F.lit(1)) - F.count(column(f.name))).alias("null_count"),
        )
        for i, f in enumerate(df.schema, start=1)
    ]
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))
