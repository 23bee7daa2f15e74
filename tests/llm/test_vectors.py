"""Vector codes against a plain restatement, the curve, and the shortlists."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from tickloom.llm import vector_codes as V

ROWS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        T.StructField("code", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("of", T.LongType()),
    ]
)


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """vec_id, label, code, error, one part and one entry at a time; and the codebooks."""
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    lengths = [len(v) for _, v, _ in kept]
    length = max(set(lengths), key=lambda n: (lengths.count(n), n))
    width = length // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    own = sorted((k for k in kept if len(k[1]) == length), key=lambda k: (k[0] is None, k[0] or 0, k[1]))
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    books = []
    for p in range(parts):
        book = [cut(v, p) for _, v, _ in own[:entries]]
        for _ in range(rounds):
            members = [[] for _ in book]
            for _, v, _ in own:
                x = cut(v, p)
                members[min(range(len(book)), key=lambda e: (far(x, book[e]), e))].append(x)
            book = [[sum(c) // len(m) for c in zip(*m)] if m else b for m, b in zip(members, book)]
        books.append(book)
    out = []
    for i, v, label in kept:
        if len(v) != length:
            out.append((i, label, None, None))
            continue
        best = [min((far(cut(v, p), b), e) for e, b in enumerate(books[p])) for p in range(parts)]
        out.append((i, label, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)))
    return out, books


def odd_vectors(seed, n, length=16):
    r = random.Random(seed)
    vector = lambda: [np.float32(r.choice((r.gauss(0, 0.2), round(r.gauss(0, 1), 1)))).item() for _ in range(length)]
    rows = [(i, vector(), r.choice((1, 1, 1, 2, None))) for i in range(n)]
    rows += [(3, rows[3][1], 1)] * 5  # repeated rows
    rows += [(5, vector(), 2), (None, vector(), 1), (None, None, 1)]
    rows += [(n + 1, None, 1), (n + 2, [*vector()[1:], None], 1), (n + 3, [*vector()[1:], math.nan], 2), (n + 4, [*vector()[1:], -math.inf], None)]
    rows += [(n + 5, [], 1), (n + 6, vector() * 2, 2), (n + 7, vector()[1:], None)]
    rows += [(n + 10 + i, [0.5] * length, 3) for i in range(n // 3)]  # one vector for a quarter of the rows
    r.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "c", 1, 2) for i, v, label in rows], ROWS).repartition(5)


def results(found):
    codes, books = found
    rows = [(r.vec_id, r.label, None if r.code is None else bytes(r.code).hex(), r.error) for r in codes.collect()]
    return sorted(rows, key=repr), books


@pytest.mark.parametrize(("n", "parts", "entries", "rounds"), [(300, 8, 16, 6), (40, 4, 3, 2), (10, 8, 16, 6), (60, 2, 16, 0)])
def test_codes_equal_plain_ones(spark, n, parts, entries, rounds):
    rows = odd_vectors(n, n)
    got, books = results(V.compress(frame(spark, rows), parts, entries, rounds))
    want, want_books = plain(rows, parts, entries, rounds)
    assert books.tolist() == want_books
    assert got == sorted(want, key=repr)


def test_no_vectors(spark):
    assert V.compress(frame(spark, []))[0].count() == 0
    assert results(V.compress(frame(spark, [(1, None, 1), (2, [math.nan] * 8, 1)])))[0] == []
    assert results(V.compress(frame(spark, [(1, [], 1)])))[0] == [(1, 1, "00" * 8, 0)]


def test_what_cannot_be_coded_is_said(spark):
    with pytest.raises(ValueError, match="equal parts"):
        V.compress(frame(spark, [(1, [1.0] * 12, 1)]))
    with pytest.raises(Exception, match="beyond"):
        V.compress(frame(spark, [(1, [1e30] * 8, 1)]))


def test_query_columns(spark, tmp_path):
    rows = odd_vectors(4, 50)
    frame(spark, rows).write.parquet(f"file://{tmp_path}/embeddings.parquet")
    got = V.op13_vector_codes(spark, f"file://{tmp_path}").collect()
    want, books = plain(rows)
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    total = {label: sum(w[3] or 0 for w in want if w[1] == label) for label in {w[1] for w in want}}
    assert sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got), key=repr) == sorted(
        ((i, code, error, total[label], digest) for i, label, code, error in want), key=repr
    )


@pytest.mark.parametrize(("width", "side"), [(2, 16), (3, 8)])
def test_curve_goes_from_neighbour_to_neighbour(width, side):
    grid = np.stack(np.meshgrid(*[np.arange(side)] * width, indexing="ij"), -1).reshape(-1, width)
    keys = V.hilbert_keys(grid)
    assert len(set(keys.tolist())) == len(grid)
    steps = np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1)
    assert (steps == 1).all()


@pytest.mark.parametrize("seed", range(20))
def test_shortlists_hold_the_nearest_entry(seed):
    r = np.random.default_rng(seed)
    vectors = r.integers(-200, 200, (12, 12))[r.integers(0, 12, 1500)] + r.integers(-20, 20, (1500, 12))
    books = np.stack([vectors[r.integers(0, 1500, 9), p : p + 4] for p in (0, 4, 8)])
    books[:, 5] = books[:, 2]  # ties
    b = V.blocks_of(vectors, 3)
    short = V.shortlists(b.part, b.low, b.high, books)
    assert short.any(1).all() and not short.all()
    for k, p in enumerate(b.part):
        own = b.points[b.first[k] : b.first[k + 1]]
        all_pick, _ = V.nearest(own, books[p])
        listed = np.flatnonzero(short[k])
        pick, far = V.nearest(own, books[p][listed])
        assert (listed[pick] == all_pick).all()
        assert (far == ((own - books[p][all_pick]) ** 2).sum(1)).all()
        assert (b.sums[k] == own.sum(0)).all()
    assert sorted(b.order.tolist()) == sorted(list(range(1500)) * 3)
