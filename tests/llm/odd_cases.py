"""Rows that an operator must not stumble over."""

import random

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, recipe string, fp string, h string, "
          "key string, bucket string, row string, label string, item string, at string, seed string, ids string, "
          "__id string, __digest string, __gone string, mark string, _mark string, kept string")
LINE = "A line of more than fifty bytes that many of the documents share, é included."


def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, shared lines, near copies."""
    draw = random.Random(5)
    words = [w for w in "the of and to in is it red blue green apple pear Maison Straße niño über x1 42 ß ! -- ...".split()]

    def prose(n):
        return " ".join(draw.choice(words) + draw.choice(["", ".", ",", "!"]) for _ in range(n))

    long = prose(4000)
    texts = [None, "", " \n\t ", "one", "two words", "one", "", prose(30), prose(60), long, long, long[:9000] + " x " + long[9000:],
             "é" * 60, "日本語 テキスト 　 end", "a\u0085b", "<|endoftext|> <|x", "'s don't I'LL 're", "\n\n  \n a", "ab" * 200]
    texts += [f"{prose(8)} {LINE} {prose(8)}" for _ in range(60)]
    base = prose(150).split()
    for i in range(40):
        copy = list(base)
        copy[3 * i] = "changed"
        texts.append(" ".join(copy))
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [rows[7], rows[7], (None, prose(12)), (None, rows[8][1]), (None, None), (-5, rows[9][1]), (2 ** 62, "one")]
    return rows
