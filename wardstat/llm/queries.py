"""One query for each operator over its whole table, and the SQL of those that SQL can express."""

import public_tokenizers
from pyspark.sql import functions as F

from wardstat.llm import (
    byte_bpe, decontaminate, exact_dedup, hard_negatives, near_vectors, ngrams, quality, simhash, suffixes,
    token_file, toxicity, warc, whitening)
from wardstat.llm.blocks import ship


def table(spark, sf_dir, name):
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark, sf_dir):
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"), keep_bytes=False).drop("kept")


def op2_simhash(spark, sf_dir):
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op3_warc_dictionary(spark, sf_dir):
    pages = warc.roles(table(spark, sf_dir, "pages"))
    records = warc.read_archives(warc.write_archives(pages))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.quality_scores(docs, model).select("doc_id", "held_out", "score", "predicted")


def op5_ngrams(spark, sf_dir):
    scores = ngrams.perplexity_scores(table(spark, sf_dir, "documents"))
    # Sums of doubles: six decimals are the same in any order.
    return scores.withColumns({c: F.round(c, 6) for c in ("base_score", "score")})


def op6_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, ranks).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    tagger = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.toxicity_scores(docs, tagger).select("doc_id", "held_out", "score", "predicted")


def op9_token_files(spark, sf_dir):
    manifest = token_file.write_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return token_file.read_tokens(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_decontamination(spark, sf_dir):
    return decontaminate.overlaps(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short_items=True)


def op11_whitening(spark, sf_dir):
    made = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return made.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_near_vectors(spark, sf_dir):
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


QUERIES = {name: made for name, made in globals().copy().items() if name.startswith("op")}

def _counts(column):
    """Numbers of rows whose count is one to four."""
    return ", ".join(f"count(*) FILTER ({column} = {k}) AS n{k}" for k in (1, 2, 3, 4))


def _cuts():
    """The three discounts from those numbers."""
    made = []
    for k in (1, 2, 3):
        raw = (f"CASE WHEN n{k} > 0 THEN {k} - {k + 1} * (n1::DOUBLE / (n1 + 2 * n2)) * n{k + 1} / n{k} ELSE 0 END")
        made.append(f"CASE WHEN n1 = 0 OR n2 = 0 OR ({raw}) <= 0 THEN 0.5 * {k} ELSE least({raw}, {k}) END AS d{k}")
    return ", ".join(made)


def _cut(count, level):
    return (f"(CASE least({count}, 3) WHEN 1 THEN {level}.d1 WHEN 2 THEN {level}.d2 WHEN 3 THEN {level}.d3 "
            "ELSE 0 END)")


# The patterns of ``decontaminate`` for a library without intersections of classes.
_UNSPACED = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")
_NOT = "".join(rf"\p{{{name}}}" for name in _UNSPACED)
_WORDS = r"[\p{L}\p{N}]+"
_LETTERS = "|".join([*(rf"[^\P{{L}}\P{{{name}}}]" for name in _UNSPACED), rf"(?:[^\P{{L}}{_NOT}]|[^\P{{N}}{_NOT}])+"])

ORACLE = {
    # Every window of 50 bytes with the first document that it starts in; runs of covered windows.
    "op1_suffix_dedup": """
        WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS body FROM documents),
        w AS (SELECT doc_id, p, array_slice(body, p, p + 49) AS piece
              FROM (SELECT doc_id, body, unnest(range(1, octet_length(body) - 48)) AS p FROM d)),
        seen AS (SELECT piece, min(doc_id) AS first FROM w GROUP BY piece),
        gone AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before
                 FROM w JOIN seen USING (piece) WHERE doc_id > first),
        marked AS (SELECT doc_id, p, sum(CASE WHEN p <= before + 50 THEN 0 ELSE 1 END)
                       OVER (PARTITION BY doc_id ORDER BY p) AS span FROM gone),
        spans AS (SELECT doc_id, min(p) AS a, max(p) + 49 AS b FROM marked GROUP BY doc_id, span),
        cut AS (SELECT doc_id, count(*) AS n_spans, sum(b - a + 1) AS n_removed, list(a ORDER BY a) AS a,
                    list(b ORDER BY a) AS b FROM spans GROUP BY doc_id)
        SELECT doc_id, octet_length(body)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
            coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(CASE WHEN a IS NULL THEN body ELSE list_reduce(
                [array_slice(body, CASE WHEN k = 0 THEN 1 ELSE b[k] + 1 END,
                             CASE WHEN k = len(a) THEN octet_length(body) ELSE a[k + 1] - 1 END)
                 for k in range(len(a) + 1)], lambda x, y: x || y) END) AS kept_sha256
        FROM d LEFT JOIN cut USING (doc_id)""",
    # Base32 of SHA-1: twenty bits of five hexadecimal digits make four letters.
    "op3_warc_dictionary": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        g AS (SELECT body, max(page_id) AS last, sha1(body) AS hex FROM p GROUP BY body)
        SELECT page_id, strlen(body)::BIGINT AS payload_bytes, array_to_string([
                substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, k // 4 * 5 + 1, 5))::INTEGER
                    >> (15 - k % 4 * 5)::INTEGER) & 31), 1) for k in range(32)], '') AS payload_digest,
            CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> last THEN last END AS refers_to
        FROM p JOIN g USING (body)""",
    # The fold is crc32 by its table; a word holds no space, so a space is the end.
    "op5_ngrams": f"""
        WITH crc AS (SELECT [list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384)
                ELSE c >> 1 END, i) for i in range(256)] AS t),
        d AS (SELECT doc_id, xor(list_reduce([ascii(x)::BIGINT for x in string_split(doc_id::VARCHAR, '')],
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 5 = 1 AS held_out,
            list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), ' ') AS w FROM documents, crc),
        e AS (SELECT *, list_prepend(chr(10), w[:-2]) AS v FROM d),
        tokens AS (SELECT doc_id, held_out, unnest(w) AS w, unnest(v) AS v, unnest(list_prepend(chr(10), v[:-2])) AS u FROM e),
        one AS (SELECT w, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY w),
        total AS (SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS v FROM one),
        three AS (SELECT u, v, w, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY u, v, w),
        two AS (SELECT v, w, count(*) AS k FROM three GROUP BY v, w),
        follow AS (SELECT w, count(*) AS k FROM two GROUP BY w),
        high AS (SELECT {_cuts()} FROM (SELECT {_counts('c')} FROM three)),
        mid AS (SELECT {_cuts()} FROM (SELECT {_counts('k')} FROM two)),
        low AS (SELECT {_cuts()} FROM (SELECT {_counts('k')} FROM follow)),
        spread AS (SELECT sum({_cut('k', 'low')}) / sum(k) AS s, sum(k) AS types FROM follow, low),
        pair AS (SELECT u, v, sum(c) AS c, sum({_cut('c', 'high')}) AS mass FROM three, high GROUP BY u, v),
        single AS (SELECT v, sum(k) AS k, sum({_cut('k', 'mid')}) AS mass FROM two, mid GROUP BY v),
        chance AS (SELECT t.doc_id, t.held_out, one.c IS NOT NULL AS known,
                log10((coalesce(one.c, 0) + 0.5) / (total.n + 0.5 * (total.v + 1))) AS base,
                coalesce(greatest(three.c - {_cut('three.c', 'high')}, 0) / pair.c, 0) + coalesce(pair.mass / pair.c, 1) * (
                    coalesce(greatest(two.k - {_cut('two.k', 'mid')}, 0) / single.k, 0) + coalesce(single.mass / single.k, 1) * (
                        coalesce(greatest(follow.k - {_cut('follow.k', 'low')}, 0) / spread.types, 0)
                        + coalesce(spread.s, 1) / (total.v + 1))) AS p
            FROM tokens t CROSS JOIN total CROSS JOIN high CROSS JOIN mid CROSS JOIN low CROSS JOIN spread
            LEFT JOIN one USING (w) LEFT JOIN follow USING (w) LEFT JOIN single ON t.v = single.v
            LEFT JOIN two ON t.v = two.v AND t.w = two.w LEFT JOIN pair ON t.u = pair.u AND t.v = pair.v
            LEFT JOIN three ON t.u = three.u AND t.v = three.v AND t.w = three.w)
        SELECT doc_id, held_out, count(*) AS n_tokens, count(*) FILTER (known) AS n_known,
            (SELECT n FROM total) AS train_tokens, round(sum(base), 6) AS base_score, round(sum(log10(p)), 6) AS score
        FROM chance GROUP BY doc_id, held_out""",
    "op6_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
        g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
               sha256(body) AS text_sha256
        FROM t JOIN g USING (body)""",
    # Every pair of equal tokens of a document and an item, and the most on one diagonal among 13 tokens
    # of the item in a row; items of fewer words by words and single letters of scripts without spaces.
    "op10_decontamination": f"""
        WITH b AS (SELECT item_id, lower(text) AS t, len(regexp_extract_all(t, '{_WORDS}')) < 13 AS short FROM benchmark),
        bw AS (SELECT item_id, short, regexp_extract_all(t, '{_WORDS}') AS w FROM b WHERE NOT short
               UNION ALL SELECT item_id, short, regexp_extract_all(t, '{_LETTERS}') FROM b WHERE short),
        dw AS (SELECT doc_id, false AS short, regexp_extract_all(lower(text), '{_WORDS}') AS w FROM documents
               UNION ALL SELECT doc_id, true, regexp_extract_all(lower(text), '{_LETTERS}') FROM documents
               WHERE EXISTS (FROM b WHERE short)),
        dt AS (SELECT doc_id, short, unnest(w) AS token, generate_subscripts(w, 1) AS i FROM dw),
        bt AS (SELECT item_id, short, len(w) AS size, unnest(w) AS token, generate_subscripts(w, 1) AS j FROM bw),
        hit AS (SELECT doc_id, item_id, least(13, size) AS span, count(*) OVER (
                    PARTITION BY doc_id, item_id, i - j ORDER BY j RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) AS n
                FROM dt JOIN bt USING (short, token))
        SELECT doc_id, item_id, max(span)::INTEGER AS "window", max(n)::INTEGER AS matched FROM hit
        WHERE n >= CASE WHEN span < 8 THEN span ELSE ceil(span * 8 / 10) END GROUP BY ALL""",
    # Every pair of vectors of a label; the ids that each reaches.
    "op12_near_vectors": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
            WHERE label IS NOT NULL AND list_bool_and([coalesce(isfinite(c), false) for c in embedding])
                AND list_bool_or([c <> 0 for c in embedding])),
        links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
                  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
        reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings
                  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        root AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
        degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
        FROM embeddings JOIN root USING (vec_id) LEFT JOIN degree USING (vec_id)""",
    # Every score of every anchor; products of whole numbers are exact in doubles.
    "op13_hard_negatives": """
        WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                [floor(256 * c::DOUBLE) for c in embedding] AS x FROM embeddings
            WHERE label IS NOT NULL AND list_bool_and([coalesce(isfinite(c), false) for c in embedding])),
        s AS (SELECT a.vec_id AS a, a.label = b.label AS alike, b.vec_id AS b, list_dot_product(a.x, b.x)::BIGINT AS s
            FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
        p AS (SELECT a, b, s FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5)
        SELECT p.a AS anchor_id, p.b AS positive_id, (row_number() OVER w)::INTEGER AS rank, s.b AS negative_id,
            p.s AS positive_score, s.s AS negative_score
        FROM p JOIN s ON p.a = s.a AND NOT s.alike AND 50 * p.s <= 100 * s.s AND 100 * s.s <= 95 * p.s
        WINDOW w AS (PARTITION BY p.a, p.b ORDER BY s.s DESC, s.b) QUALIFY rank <= 3""",
}
