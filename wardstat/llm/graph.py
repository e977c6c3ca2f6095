"""Connected components of a graph whose edges are a table."""

from pyspark.sql import functions as F

from wardstat.llm.blocks import saved


#: Groups that the rows of one node are dealt to.
SALT = 32


def with_least(rows, key, by, **least):
    """Rows with the least value of columns over all rows of their key, ``name=column``.

    Rows of one key are dealt to ``SALT`` groups by another column. Each group
    sends one row to its key and gets one back, so a key with very many rows
    never comes together.
    """
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALT)))
    groups = salted.groupBy(key, "salt").agg(*(F.min(c).alias(name) for name, c in least.items()))
    whole = groups.groupBy(key).agg(*(F.min(name).alias(name) for name in least))
    return salted.join(groups.select(key, "salt").join(whole, key), [key, "salt"]).drop("salt")


def _rounded(edges):
    """One large-star and one small-star step: neighbours are hung on the smallest node that is known."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    large = with_least(both, "a", "b", m="b").where("b > a").select(
        F.col("b").alias("a"), F.least("a", "m").alias("b")).where("a != b")
    hung = with_least(large, "a", "b", m="b")
    return (hung.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
            .union(hung.select("a", F.col("m").alias("b"))).distinct())


def connected_components(edges, a="a", b="b"):
    """``node, root`` for every node of an edge that is not itself the smallest node of its component.

    Nodes are longs. Edges with a null end or two equal ends link nothing. Each
    round is written to the shared folder; the number of rounds grows with the
    logarithm of the component's diameter. The edges of a node with very many
    neighbours are dealt to groups and never come together.
    """
    now = saved(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                .where("a != b").distinct(), "edges")

    def mark(table):
        return table.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()

    seen = mark(now)
    while seen[0]:
        now = saved(_rounded(now), "edges")
        last, seen = seen, mark(now)
        if seen == last:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
