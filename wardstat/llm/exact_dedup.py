"""Exact deduplication by recipes of content-defined chunks, in DataFrame operations only.

A text is cut where its own content says so: after a full stop, question or
exclamation mark or line break, at the earliest ``MIN_CHARS`` characters after
the last cut and at the latest ``MAX_CHARS``. A chunk's identifier is its 64-bit
hash once that is proven to belong to one chunk only: the pairs of identifier and
half a SHA-256 are deduplicated, with a map-side part, and no identifier may have
two. Then ordered identifier lists are compared, 8 bytes for about a thousand.
"""

from pyspark.sql import functions as F

from wardstat.functions.names import column
from wardstat.llm.blocks import saved
from wardstat.operators.profiling import first_row_per_key

MIN_CHARS = 512
MAX_CHARS = 4096


def chunks(text):
    """The chunks of a text column, in order; joined they are the text."""
    pattern = rf"(?s).{{{MIN_CHARS},{MAX_CHARS - 1}}}?[.!?\n]|.{{1,{MAX_CHARS}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def shared_identifiers(listed):
    """Identifiers that more than one chunk has, from a table of ``parts``; as good as always empty."""
    distinct = listed.select(F.explode("parts").alias("part")).select("part.identifier", "part.digest").distinct()
    return distinct.groupBy("identifier").agg(F.count("*").alias("n")).where("n > 1").select("identifier")


def recipes(docs, id_col="doc_id", text_col="text"):
    """``doc_id``, the ``recipe`` of verified identifiers, and ``text_sha256`` of every row.

    A row with an unverified identifier also gets its digest in ``tie``; for
    all others ``tie`` is empty. Texts are read once and stay where they are.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = F.transform(chunks(text), lambda c: F.struct(
        F.xxhash64(c).alias("identifier"), short(F.sha2(c, 256)).alias("digest")))
    listed = saved(docs.select(F.col(id_col).alias("doc_id"), parts.alias("parts"), F.sha2(text, 256).alias("text_sha256")),
                   "recipes")
    doubtful = saved(shared_identifiers(listed), "shared-identifiers")
    listed = listed.select("doc_id", F.col("parts.identifier").alias("recipe"), "text_sha256")
    if doubtful.isEmpty():
        return listed.withColumn("tie", F.lit(""))
    unsure = (listed.select("recipe", F.explode("recipe").alias("identifier"))
              .join(doubtful, "identifier", "left_semi").select("recipe").distinct()
              .select("recipe", F.lit(True).alias("unsure")))
    return (listed.join(unsure, "recipe", "left")
            .withColumn("tie", F.when(F.col("unsure"), F.col("text_sha256")).otherwise("")).drop("unsure"))


def exact_groups(docs, id_col="doc_id", text_col="text"):
    """The group of equal texts of every row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    The row with the largest id stays. A null text counts as empty; empty texts
    are equal. Null ids stay only in groups without any id. Rows that repeat
    both id and text stay or go together. Other columns are not looked at; an
    empty table gives an empty table.

    The groups are counted with a map-side part and joined back on the recipe:
    adaptive execution splits the rows of a hot recipe.
    """
    rows = recipes(docs, id_col, text_col)
    groups = rows.groupBy("recipe", "tie").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return rows.join(groups, ["recipe", "tie"]).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def short(sha256):
    """The first 16 bytes of a digest in hexadecimal digits."""
    return F.unhex(F.substring(sha256, 1, 32))


def digest(text):
    """What tells the texts of one id apart, half a SHA-256; a null text counts as empty."""
    return short(F.sha2(F.coalesce(text, F.lit("")), 256))


def decided(rows):
    """Of ``doc_id, digest, kept`` for every row, the pairs that do not stay or that more than one row has."""
    return (rows.groupBy("doc_id", "digest").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
            .where("not kept or n > 1"))


def free_name(docs, name):
    """The name, with as many ``_`` before it as no column of the table has."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def without(docs, marks, id_col="doc_id", text_col="text"):
    """``docs`` without the pairs of id and text that are not kept, and one row of each other pair in ``marks``.

    Of several rows the smallest in column order stays. Null ids are compared as
    any other. Rows and marks meet in one sorted merge, whatever their size: the
    rows move once, and those of one pair can be split.
    """
    mark = free_name(docs, "mark")
    marks = saved(marks.select(F.struct(F.col("doc_id").alias("id"), "digest", "kept").alias(mark)), "decided")
    pair = F.col(id_col).eqNullSafe(F.col(f"{mark}.id")) & (digest(F.col(text_col)) == F.col(f"{mark}.digest"))
    once = docs.join(marks.hint("merge"), pair, "left_anti")
    again = marks.where(F.col(f"{mark}.kept"))
    if again.isEmpty():
        return once
    more = docs.join(again.hint("merge"), pair, "inner")
    # Maps have no order: of rows with any, one stays, whichever it is.
    ordered = not any("map<" in kind or "variant" in kind for _, kind in docs.dtypes)
    picked = first_row_per_key(more, [mark]) if ordered else more.dropDuplicates([mark])
    return once.unionByName(picked.select(*[column(c) for c in docs.columns]))


def drop_exact_copies(docs, id_col="doc_id", text_col="text", spare_null_ids=True):
    """The rows of ``docs`` that stay, with all their columns: one of each group of equal texts.

    That with the largest id stays, of rows that repeat both id and text the
    smallest in column order. A row is judged by its own text: another text
    under the same id is not touched. With ``spare_null_ids`` rows with a null id
    all stay, else they go as any other copy, and one stays where no row has an id.
    """
    rows = exact_groups(docs, id_col, text_col).withColumn("digest", short("text_sha256"))
    if spare_null_ids:
        rows = rows.where("doc_id is not null")
    return without(docs, decided(rows), id_col, text_col)
