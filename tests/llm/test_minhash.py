"""Near duplicates by MinHash against all pairs, and what leaders alone would miss."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tickloom.llm import minhash_bayes as M

from .cases import documents, jaccard_labels, odd_texts, shingle_set, story
from .test_groups import families


def edited(seed, n, words, most):
    """Edited copies of one text, many of them right around the threshold."""
    r = random.Random(seed)
    base = story(seed, words).split()
    rows = []
    for i in range(n):
        copy = list(base)
        for _ in range(r.randint(1, most)):
            copy[r.randrange(words)] = f"e{r.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    return rows


def found(spark, rows, size, num, den=100):
    return {r.id: (r.n_shingles, r.component) for r in M.near_components(documents(spark, rows), size, num, den).collect()}


def plain(rows, size, num, den=100):
    sets = [shingle_set(t, size) for _, t in rows]
    return {i: (len(s), g) for (i, _), s, g in zip(rows, sets, jaccard_labels(sets, num, den))}


@pytest.mark.parametrize(("size", "num"), [(2, 80), (5, 80), (3, 90)])
def test_components_equal_all_pairs(spark, size, num):
    rows = families(num + size, 50)
    want = plain(rows, size, num)
    assert found(spark, rows, size, num) == want
    assert len(set(want.values())) < len(rows) - 20


def test_family_around_the_threshold_in_small_blocks(spark, monkeypatch):
    """Nodes that leaders don't reach are linked by opened buckets and zones, also over several blocks."""
    monkeypatch.setattr(M, "BLOCK", 4)
    rows = edited(1, 160, 150, 16)
    seen, settled = [], M.settled
    monkeypatch.setattr(M, "settled", lambda *a: seen.append(settled(*a)) or seen[-1])
    want = plain(rows, 2, 80)
    assert found(spark, rows, 2, 80) == want
    assert seen[0].count() < len(rows)  # a tree per block, not the likely pairs
    assert 1 < len({c for _, c in want.values()}) < 150


def test_odd_documents(spark):
    rows = odd_texts()
    got = M.near_components(documents(spark), 2, 80, 100).collect()
    sets = [shingle_set(t, 2) for _, t in rows]
    labels = jaccard_labels(sets, 80, 100)
    least = {g: min((i for (i, _), x in zip(rows, labels) if x == g and i is not None), default=None) for g in labels}
    want = Counter((i, len(s), least[g] if s else i) for (i, _), s, g in zip(rows, sets, labels))
    assert Counter((r.id, r.n_shingles, r.component) for r in got) == want


def test_no_documents(spark):
    assert M.near_components(documents(spark, [])).count() == 0


def test_batches_rule_out_what_the_posterior_does():
    """The rule against the posterior summed over a fine grid of agreements."""
    p = (np.arange(200_000) + 0.5) / 200_000
    for k, least in M.least_matches(0.8, 235):
        p0 = 0.8 + 0.2 / 256
        for m in (least - 1, least):
            weight = np.exp(m * np.log(p) + (k - m) * np.log1p(-p) - (m * np.log(m / k) + (k - m) * np.log1p(-m / k) if 0 < m < k else 0))
            chance = weight[p >= p0].sum() / weight.sum()
            assert (chance >= M.POSTERIOR_MISS) == (m >= least)


def test_signatures_estimate_similarity():
    r = np.random.default_rng(1)
    hashes = M.bands_for(0.8) * M.ROWS
    for similarity in (0.5, 0.8, 0.95):
        both = int(2000 * similarity)
        x = r.integers(0, 1 << 63, 4000 - both, dtype=np.uint64)
        one, two = np.sort(x[:2000]), np.sort(np.concatenate([x[:both], x[2000:]]))
        s = M.signatures(np.concatenate([one, two]), np.array([0, 2000, 2000 + len(two)]), 4 * hashes)
        exact = len(np.intersect1d(one, two)) / len(np.union1d(one, two))
        assert abs((s[0] == s[1]).mean() - exact) < 0.05


def test_groups_of_sorted_rows_stay_whole():
    r = random.Random(5)
    keys = sorted(r.randrange(12) for _ in range(200))
    for _ in range(20):
        cuts = sorted({0, 200, *(r.randrange(200) for _ in range(r.randint(0, 30)))})
        batches = [pa.RecordBatch.from_arrays([pa.array(keys[a:b], pa.int64())], ["k"]) for a, b in zip(cuts, cuts[1:])]
        got = [b.column("k").to_pylist() for b in M.whole_groups(iter(batches), "k")]
        assert [k for g in got for k in g] == keys
        assert all(not set(a) & set(b) for n, a in enumerate(got) for b in got[n + 1 :])
