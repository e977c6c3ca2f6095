"""The corpus pipeline: stages over ``documents``, each of them an operator of ``wardstat.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. Every stage but the
last returns the columns of ``documents``.
"""

import public_tokenizers

from wardstat.llm import byte_bpe, decontaminate, exact_dedup, simhash, toxicity
from wardstat.llm.blocks import saved, ship


def clean(spark, docs, sf_dir):
    """Documents that the toxicity field does not reject."""
    labels = ship(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def unique(spark, docs, sf_dir):
    """Of equal texts, the document with the largest id; null ids are no exception."""
    return exact_dedup.drop_exact_copies(docs, spare_null_ids=False)


def distinct(spark, docs, sf_dir):
    """Of documents whose fingerprints link at two bits or fewer, that with the smallest id."""
    ship(spark)
    return simhash.drop_near_copies(docs, shingle=3, radius=2)


def unseen(spark, docs, sf_dir):
    """Documents that repeat no passage of a benchmark item; null ids and short items are no exception."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, benchmark, spare_null_ids=False, short_items=True)


def tokens(spark, docs, sf_dir):
    """Token ids, the characters of each token, and the bytes that the ids decode to."""
    ship(spark)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.decode(byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)


STAGES = [
    ("toxicity", clean), ("exact-dedup", unique), ("simhash-near-dedup", distinct),
    ("decontamination", unseen), ("byte-level-bpe", tokens)]
#: The field, the components of fingerprints and the merges have no SQL form.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to the table ``documents``, each to all that the one before kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
