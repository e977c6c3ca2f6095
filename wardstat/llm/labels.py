"""Bounded samples of labelled documents, for classifiers."""

from pyspark.sql import functions as F

#: A sample holds at most this many documents of each label, of at most this many characters each.
SAMPLE_DOCS = 1000
SAMPLE_CHARS = 10_000


def training_fold(column):
    """True for the ids to learn from: crc32 of the id as text is no multiple of 5."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5 != 0


def sample(docs, labels, label_col, id_col="doc_id", text_col="text", each=SAMPLE_DOCS):
    """``text, label``: the same documents at every run, by a hash of their ids, from the training fold alone.

    The ids are chosen from the labels, so that only they travel to the
    documents. Null labels and ids are left out.
    """
    known = labels.where(training_fold("doc_id") & F.col(label_col).isin(0, 1)).select(
        F.col("doc_id").alias("__id"), F.col(label_col).cast("int").alias("label"))
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("label") == label).orderBy(F.xxhash64("__id"), "__id").limit(each)
        chosen = part if chosen is None else chosen.union(part)
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # At most twice SAMPLE_DOCS ids are broadcast.
    return (rows.where(F.length("text") <= SAMPLE_CHARS).join(F.broadcast(chosen), "__id")
            .orderBy(F.xxhash64("__id"), "__id", "text").select("text", "label"))
