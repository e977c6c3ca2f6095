"""Wide results to long ones."""

from wardstat.functions.names import quoted


def aggregates_as_rows(df, measures, label, value):
    """Aggregate once, then one row per measure. ``measures`` is ``{label: column}``."""
    wide = df.agg(*[agg.alias(name) for name, agg in measures.items()])
    return wide.unpivot([], [quoted(name) for name in measures], label, value)


def to_long(df, index, metrics, label="METRIC", value="VALUE"):
    """One row per index value and metric, for plotting clients."""
    return df.unpivot([index], list(metrics), label, value)
