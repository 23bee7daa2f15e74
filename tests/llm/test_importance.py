"""Importance resampling against a plain restatement."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tickloom.llm import importance as I

from .cases import _LOWER, documents, odd_texts, story


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_LOWER))


def plain_features(text, longest, buckets):
    w = plain_words(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def plain(docs, target, share=25, least_words=20, longest=2, buckets=10_000, seed=7):
    """doc_id, n_features, weight, score, rank; ranks of rows with equal scores and ids in any order."""
    source = Counter(b for _, t in docs for b in plain_features(t, longest, buckets))
    goal = Counter(b for _, t in target for b in plain_features(t, longest, buckets))
    s_all, t_all = sum(source.values()), sum(goal.values())
    gain = [math.floor(1000 * math.log((goal[b] + 1) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    rows, enough = [], []
    for i, t in docs:
        f = plain_features(t, longest, buckets)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(f), weight, score, None])
        if len(plain_words(t)) >= least_words:
            enough.append(rows[-1])
    enough.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for n, r in enumerate(enough[: share * len(enough) // 100]):
        r[4] = n + 1
    return sorted(map(tuple, rows), key=repr)


def texts(seed, n):
    """Texts of shared lines, blank lines, line ends of all kinds and single words per line."""
    r = random.Random(seed)
    lines = [story(i, r.randint(1, 12)) for i in range(20)] + ["", " -- ", "Same LINE", "same line!", "É1 é", "one"]
    rows = [(i, r.choice(("\n", "\r\n", "\n\n")).join(r.choice(lines) for _ in range(r.randint(0, 12)))) for i in range(n)]
    return rows + [(n, "\n".join(["same line"] * 3000)), (n + 1, "w" * 300 + " " + "w" * 299 + "x v"), (n + 2, "end\n"), (n + 2, "end\n")]


def got(spark, docs, target, **more):
    found = I.resample(documents(spark, docs), documents(spark, target), **more)
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in found.collect()), key=repr)


@pytest.mark.parametrize(("longest", "buckets", "share"), [(2, 10_000, 25), (3, 50, 60), (1, 7, 100)])
def test_equals_plain_resampling(spark, longest, buckets, share):
    docs, target = texts(1, 80), texts(2, 9)
    more = dict(longest=longest, buckets=buckets, share=share, least_words=5)
    assert got(spark, docs, target, **more) == plain(docs, target, **more)


def test_odd_documents(spark):
    rows = odd_texts()
    found, want = got(spark, rows, rows[:3]), plain(rows, rows[:3])
    assert [r[:4] for r in found] == [r[:4] for r in want]
    assert sorted(r[4] for r in found if r[4]) == list(range(1, 1 + sum(r[4] is not None for r in want)))


def test_one_id_for_a_third_of_all_rows(spark):
    rows = [(9, story(1, 30))] * 60 + [(i, story(i, 30)) for i in range(100, 220)]
    found, want = got(spark, rows, rows[70:75]), plain(rows, rows[70:75])
    assert sorted(r[4] for r in found if r[4]) == list(range(1, 46))
    assert Counter(r[:4] for r in found if r[4]) == Counter(r[:4] for r in want if r[4])


def test_empty_tables(spark):
    docs = texts(3, 20)
    assert got(spark, [], docs) == []
    assert got(spark, docs, []) == plain(docs, [])


def test_checksums_of_words():
    words = [b"", b"a", b"abc", bytes(range(97, 123)) * 20, b"zz" * 32, b"z" * 65]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    state = I.crc_on(np.full(len(words), 0xFFFFFFFF, np.uint32), data, ends - [len(w) for w in words], ends)
    assert (state ^ np.uint32(0xFFFFFFFF)).tolist() == [zlib.crc32(w) for w in words]


def test_equal_lines_are_one_segment():
    words = I.words_of(pa.array(["A b\nc\na, B!", None, "a b", "x " * 3000]))
    example, content, count = words.distinct()
    assert sorted(count.tolist()) == [1, 1, 2, 3]
    assert sorted(words.lines(example).to_pylist(), key=len)[:2] == ["c", "a b"]
    assert len(content) == 1 + 2 + 1 + 3
