"""Rules for column names. They handle metadata only, never data."""

import re

from pyspark.sql import functions as F

# Characters a table name may not hold.
FORBIDDEN = r"[ ,;{}()\n\t=]+"


def quoted(name):
    """The name in backticks, so that dots and blanks in it stay literal."""
    return "`" + name.replace("`", "``") + "`"


def column(name):
    return F.col(quoted(name))


def sanitized(name):
    """Runs of forbidden characters become one ``_``; none at either end."""
    return re.sub(FORBIDDEN, "_", name).strip("_")


def standardized(name):
    """Trimmed, upper case, blanks as ``_``."""
    return name.strip().upper().replace(" ", "_")


def rename_all(df, rule):
    """Apply ``rule`` to every column name; refuse names that would collide.

    Names are compared without case, as Spark resolves them.
    """
    sources = {}
    for name in df.columns:
        sources.setdefault(rule(name).lower(), []).append(name)
    clashes = [names for names in sources.values() if len(names) > 1]
    if clashes:
        raise ValueError(f"columns share a name after renaming: {clashes}")
    return df.toDF(*[rule(name) for name in df.columns])
