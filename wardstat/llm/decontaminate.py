"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

A seed hashes the tokens at a mask's positions and ignores those between. The two
masks are lossless for the rule that is checked: any ``WINDOW`` tokens of an item
that a document repeats with at most two of them replaced hold a hit of one of
them. Hits of test and training seeds are verified on the tokens around them.
"""

from math import ceil

from pyspark.sql import functions as F

from wardstat.llm.blocks import saved
from wardstat.llm.exact_dedup import digest, free_name

WINDOW = 13
SIMILARITY = 0.8
#: Positions that count, of 8 and 9 tokens: each 13 with two replaced hold one of them whole. All start with 0 and 1.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
#: Items of fewer tokens are no evidence; those between this and ``WINDOW`` must be found whole.
LEAST_TOKENS = 8
#: The benchmark is broadcast up to this number of seeds and this number of bytes of its items, else all meets by shuffles.
BROADCAST_SEEDS = 1_000_000
BROADCAST_BYTES = 64 << 20
#: Tokens, and those of ``short_tokens``: scripts without spaces between words give a token for each letter.
WORDS = r"[\p{L}\p{N}]+"
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
LETTERS = rf"[\p{{L}}&&[{UNSPACED}]]|[\p{{L}}\p{{N}}&&[^{UNSPACED}]]+"


def tokens(text, pattern=WORDS):
    """Hashes of the runs of letters or digits of a text column, lower-cased."""
    words = F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))
    return F.transform(F.coalesce(words, F.array().cast("array<string>")), lambda w: F.xxhash64(w))


def seeds(hashes, at, masks):
    """``seed`` of every mask that fits at the token ``at``, as an array; every mask starts with two tokens in a row."""
    return F.filter(F.array(*(
        F.when(at + max(mask) < F.size(hashes), F.xxhash64(F.lit(number), *(F.get(hashes, at + m) for m in mask)))
        for number, mask in masks.items())), lambda seed: seed.isNotNull())


def pair(token, hashes, at):
    """Hash of a token and the next one."""
    return F.xxhash64(token, F.get(hashes, at + 1))


def benchmark_tokens(benchmark, id_col="item_id", text_col="text"):
    """Tokens of the items that are long enough, each with a number of its own, and the masks in use by their number."""
    items = (benchmark.select(F.col(id_col).alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
             .select("item_id", tokens(F.col("text")).alias("item")).where(F.size("item") >= LEAST_TOKENS).distinct())
    items = saved(items.withColumn("row", F.monotonically_increasing_id()), "benchmark-tokens")
    short = [r[0] for r in items.select(F.size("item")).distinct().where(F.size("item") < WINDOW).collect()]
    return items, dict(enumerate(MASKS)) | {n: tuple(range(n)) for n in sorted(short)}


def short_tokens(benchmark, id_col="item_id", text_col="text"):
    """As ``benchmark_tokens``, for the items of fewer than ``WINDOW`` tokens, by the pattern ``LETTERS``.

    Items of ``LEAST_TOKENS`` or more must be repeated to 80 per cent of their own
    length, shorter ones whole. A run of equal tokens that so many replaced ones
    must leave is the mask of a length.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    items = (benchmark.select(F.col(id_col).alias("item_id"), text.alias("text")).where(F.size(tokens(F.col("text"))) < WINDOW)
             .select("item_id", tokens(F.col("text"), LETTERS).alias("item")).where(F.size("item") > 0).distinct())
    items = saved(items.withColumn("row", F.monotonically_increasing_id()), "short-tokens")
    sizes = [r[0] for r in items.select(F.least(F.size("item"), F.lit(WINDOW))).distinct().collect()]
    runs = {n if n < LEAST_TOKENS else least_run(n) for n in sizes if n < WINDOW}
    return items, (dict(enumerate(MASKS)) if WINDOW in sizes else {}) | {len(MASKS) + n: tuple(range(n)) for n in sorted(runs)}


def least_run(n):
    """The longest run of equal tokens that every window of ``n`` with 80 per cent of them equal holds."""
    changed = n - ceil(SIMILARITY * n)
    return ceil((n - changed) / (changed + 1))


def broadcastable(items, known):
    """Whether the seeds, and the items' tokens and ids beside them, are few enough for every task."""
    held = F.size("item") * F.lit(8) + F.coalesce(F.octet_length(F.col("item_id").cast("string")), F.lit(0))
    return known.count() <= BROADCAST_SEEDS and (items.agg(F.sum(held.cast("long"))).first()[0] or 0) <= BROADCAST_BYTES


def fetched(rows, items, met):
    """Hits as in ``overlaps``, with no more than the tokens around them; ``met`` holds ``mark, at, row, item_at``.

    Hits on one diagonal of a document and an item are reduced to one for each
    ``WINDOW`` tokens of the item. A mark that two rows share brings the tokens of
    both, and each is checked by its own.
    """
    block = F.floor(F.col("item_at") / WINDOW).cast("int")
    spots = met.select("mark", "row", block.alias("block"), (F.col("at") - F.col("item_at") + block * WINDOW).alias("begin"))
    spots = saved(spots.distinct(), "spots")

    def around(array, begin):
        return F.transform(F.sequence(begin - (WINDOW - 1), begin + 2 * (WINDOW - 1)), lambda i: F.get(array, i))

    wanted = spots.groupBy("mark").agg(F.collect_set("begin").alias("begins"))
    held = (rows.join(wanted, "mark").select("doc_id", "mark", "held", F.explode("begins").alias("begin"))
            .select("doc_id", "mark", "begin", around("held", F.col("begin")).alias("held")).distinct())
    size = F.size("item")
    parts = (items.select("row", "item_id", "item", F.explode(F.sequence(
                F.lit(0), F.floor((size - 1) / WINDOW).cast("int"))).alias("block"))
             .select("row", "item_id", "block", size.alias("size"), around("item", F.col("block") * WINDOW).alias("item")))
    first = F.col("block") * WINDOW
    shift = (F.lit(WINDOW - 1) - first)
    return spots.join(parts, ["row", "block"]).join(held, ["mark", "begin"]).select(
        "doc_id", "item_id", "size", "held", shift.alias("held_shift"), "item", shift.alias("item_shift"),
        (first - (WINDOW - 1)).alias("low"), (first + WINDOW - 1).alias("high"))


def search(docs, items, masks, id_col, text_col, pattern=WORDS, whole=WINDOW):
    """The leaks of ``overlaps`` for items and masks; windows of fewer than ``whole`` tokens must be equal in all.

    A benchmark of a counted size, in seeds and in bytes, is broadcast: documents
    are then read once and not shuffled, and only tokens whose pair with the next
    one occurs in the benchmark are hashed by the masks. Seeds name their item by
    a number, and its tokens are there once. Beyond that size seeds meet by a
    shuffle, and only the tokens around a hit are fetched for the check.
    """
    spots = items.select("row", "item", F.posexplode("item").alias("item_at", "token"))
    known = saved(spots.select("row", "item_at", pair(F.col("token"), F.col("item"), F.col("item_at")).alias("pair"),
                               F.explode(seeds(F.col("item"), F.col("item_at"), masks)).alias("seed")), "benchmark-seeds")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), text).alias("mark"), tokens(text, pattern).alias("held"))
    # An expression, so that no filter on the array is inferred, which would split the texts once more.
    paired = all(len(mask) > 1 for mask in masks.values())
    each = F.posexplode(F.when(F.size("held") > int(paired), F.col("held")))
    found = rows.select("doc_id", "mark", "held", each.alias("at", "token"))
    marked = F.explode(seeds(F.col("held"), F.col("at"), masks)).alias("seed")
    if broadcastable(items, known):
        able = found.withColumn("pair", pair(F.col("token"), F.col("held"), F.col("at"))).join(
            F.broadcast(known.select("pair").distinct()), "pair", "left_semi") if paired else found
        hits = (able.select("doc_id", "held", "at", marked).join(F.broadcast(known.drop("pair")), "seed")
                .join(F.broadcast(items), "row")
                .select("doc_id", "item_id", F.size("item").alias("size"), "held",
                        (F.col("at") - F.col("item_at")).alias("held_shift"), "item", F.lit(0).alias("item_shift"),
                        # Windows of the item that may hold the token where the seed begins.
                        (F.col("item_at") - (WINDOW - 1)).alias("low"), F.col("item_at").alias("high")))
    else:
        met = found.select("mark", "at", marked).join(known.select("seed", "row", "item_at"), "seed")
        hits = fetched(rows, items, met)
    window = F.least(F.lit(WINDOW), F.col("size"))
    low, high = F.greatest(F.lit(0), F.col("low")), F.least(F.col("high"), F.col("size") - window)

    def matched(start):
        return F.aggregate(
            F.sequence(start, start + window - 1), F.lit(0),
            lambda n, i: n + F.coalesce(
                (F.get("held", i + F.col("held_shift")) == F.get("item", i + F.col("item_shift"))).cast("int"), F.lit(0)))

    checked = hits.select("doc_id", "item_id", window.alias("window"),
                          F.array_max(F.transform(F.sequence(low, high), matched)).alias("matched"))
    return (checked.where(F.col("matched") >= F.ceil(F.when(F.col("window") < whole, F.col("window"))
                                                     .otherwise(F.lit(SIMILARITY) * F.col("window"))))
            .groupBy("doc_id", "item_id").agg(F.max("window").alias("window"), F.max("matched").alias("matched")))


def overlaps(docs, benchmark, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text",
             short_items=False):
    """``doc_id, item_id, window, matched`` for every document and item that it leaks.

    A leak is a window of 13 tokens of the item, in a row, of which the document
    repeats 80 per cent in their places; ``matched`` is the most in any window.
    Shorter items of at least 8 tokens must be repeated whole. Null texts hold
    nothing; a null id is one document to all rows that have it, as is any
    repeated id. Items with equal ids count as one, other columns are not looked
    at, and an empty table on either side gives an empty table.

    With ``short_items``, items of fewer than 13 tokens are also searched by the
    rule of ``short_tokens``: 80 per cent of their own length from 8 tokens on,
    whole below, letters of scripts without spaces being tokens of their own.
    """
    found = search(docs, *benchmark_tokens(benchmark, item_col, item_text_col), id_col, text_col)
    if short_items:
        items, masks = short_tokens(benchmark, item_col, item_text_col)
        if masks:
            found = found.union(search(docs, items, masks, id_col, text_col, LETTERS, LEAST_TOKENS))
            found = found.groupBy("doc_id", "item_id").agg(F.max("window").alias("window"), F.max("matched").alias("matched"))
    return found


def drop_contaminated(docs, benchmark, id_col="doc_id", text_col="text", spare_null_ids=True, short_items=False):
    """The rows of ``docs`` without a leak, with all their columns.

    A row is judged by its own text: another text under the same id is not
    touched. With ``spare_null_ids`` rows with a null id all stay; ``short_items`` is that of ``overlaps``.
    """
    own = docs.select(F.struct(F.col(id_col).alias("id"), digest(F.col(text_col)).alias("digest")).alias("own"),
                      F.col(text_col).alias("text"))
    mark = free_name(docs, "mark")
    gone = overlaps(own, benchmark, "own", short_items=short_items).select(F.col("doc_id").alias(mark))
    gone = saved((gone.where(F.col(f"{mark}.id").isNotNull()) if spare_null_ids else gone).distinct(), "contaminated")
    pair = F.col(id_col).eqNullSafe(F.col(f"{mark}.id")) & (digest(F.col(text_col)) == F.col(f"{mark}.digest"))
    return docs.join(gone.hint("merge"), pair, "left_anti")
