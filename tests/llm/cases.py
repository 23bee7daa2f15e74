"""Documents with every odd case, and plain restatements that the operators are tested against."""

import re

from pyspark.sql import types as T

#: Extra columns whose names the operators use inside.
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("row", T.LongType()),
        T.StructField("tag", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("node", T.LongType()),
        T.StructField("_counts", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)
PROSE = "the quick brown fox jumps over a lazy dog while seven grey geese watch from the far side of an old river, and nobody says a word about it"
WORDS = [f"{a}{b}{c}" for a in ("ba", "ko", "ti", "mu") for b in ("la", "ren", "so") for c in ("p", "st", "na", "vi")]


def story(seed, n):
    """n words that look like a text of their own."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)])
    return " ".join(out)


def odd_texts():
    long_one = story(3, 30_000)
    return [
        (1, PROSE),
        (2, PROSE),  # a copy
        (3, None),
        (4, ""),
        (5, " \t\n\x0b \r"),
        (6, "one"),
        (7, "Two words"),
        (8, "x" * 200_000),  # one very long word
        (9, long_one),
        (10, long_one + " end"),
        (11, "É è’s “quoted” — 東京 <|endoftext|> don't we'll 12½ a\u00a0b\u0085c"),
        (None, PROSE),
        (None, "no number here but some words all the same for once"),
        (1, PROSE),  # a repeated row
        (1, story(5, 80)),  # a repeated id
        (12, "\n".join([story(6, 12)] * 5)),
        (13, story(7, 60)),
        (14, story(7, 60)),
    ]


def documents(spark, rows=None):
    rows = odd_texts() if rows is None else rows
    return spark.createDataFrame([(i, t, "k", 1, "t", "i", 2, 3, 4, 0.5) for i, t in rows], DOCS).repartition(3)


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=True):
    text = (text or "").translate(_LOWER) if lower else text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def shingle_set(text, size):
    w = words(text)
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def jaccard_labels(sets, num, den):
    """Smallest position reachable by links, per position."""
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]
