"""Jaccard groups and decontamination against all pairs and all windows."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom.llm import decontamination, jaccard_groups
from tickloom.llm.components import LEAST_FILES, components, onward, roots
from tickloom.llm.staging import staged
from tickloom.llm.words import distinct

from .cases import documents, jaccard_labels, odd_texts, shingle_set, story, words


def families(seed, n):
    """Families of edited copies, with links on both sides of the threshold, and texts of their own."""
    r = random.Random(seed)
    rows = []
    for f in range(n):
        base = [f"w{f}x{i}" for i in range(r.choice((1, 2, 3, 5, 9, 12, 20, 41, 62, 120, 400)))]
        for _ in range(r.randint(1, 9)):
            copy = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 15))):
                k = r.randrange(len(copy))
                kind = r.random()
                if kind < 0.5:
                    copy[k] = f"y{r.randrange(10**6)}"
                elif kind < 0.75 and len(copy) > 1:
                    del copy[k]
                else:
                    copy.insert(k, f"z{r.randrange(10**6)}")
            rows.append(" ".join(copy))
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("size", "num", "den"), [(3, 90, 100), (5, 80, 100)])
def test_groups_equal_all_pairs(spark, size, num, den):
    rows = families(num, 60)
    got = {r.id: (r.n_shingles, r.component) for r in jaccard_groups.jaccard_components(documents(spark, rows), size, num, den).collect()}
    sets = [shingle_set(t, size) for _, t in rows]
    labels = jaccard_labels(sets, num, den)
    assert got == {i: (len(sets[i]), labels[i]) for i, _ in rows}
    assert len(set(labels)) < len(rows) - 20


def test_large_family_in_small_groups(spark, monkeypatch):
    """A family is dealt out over many groups; links inside and across them are all found."""
    monkeypatch.setattr(jaccard_groups, "GROUP_NODES", 4)
    r = random.Random(2)
    base = story(1, 150).split()
    rows = []
    for i in range(120):
        copy = list(base)
        for _ in range(r.randint(1, 5)):
            copy[r.randrange(150)] = f"e{r.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    got = {x.id: x.component for x in jaccard_groups.jaccard_components(documents(spark, rows), 3, 90, 100).collect()}
    labels = jaccard_labels([shingle_set(t, 3) for _, t in rows], 90, 100)
    assert got == dict(enumerate(labels)) and 1 < len(set(labels)) < 110


def opened(monkeypatch):
    """Nodes whose sets are built again, and the rounds of opening, of the calls that follow."""
    nodes, rounds = [], []
    build, stage = jaccard_groups.needed_sets, jaccard_groups.staged
    monkeypatch.setattr(jaccard_groups, "needed_sets", lambda docs, sets, wanted, *more: nodes.append(wanted.count()) or build(docs, sets, wanted, *more))
    monkeypatch.setattr(jaccard_groups, "staged", lambda df, name: (name == "links" and rounds.append(name)) or stage(df, name))
    return nodes, rounds


def test_sets_that_share_a_passage_only_are_not_opened(spark, monkeypatch):
    """A common passage gives a few common tokens, fewer than a partner must have; only near copies are opened."""
    nodes, _ = opened(monkeypatch)
    r = random.Random(11)
    passage = story(40, 24)
    rows = [(i, f"{passage} " + " ".join(f"u{i}x{k}" for k in range(r.randrange(150, 400)))) for i in range(300)]
    rows += [(300 + i, f"{t} end") for i, t in rows[:10]]
    got = {x.id: x.component for x in jaccard_groups.jaccard_components(documents(spark, rows), 5, 80, 100).collect()}
    assert got == {i: i - 300 if i >= 300 else i for i, _ in rows}
    assert sum(nodes) < 100


def test_a_family_is_opened_in_rounds(spark, monkeypatch):
    """What travels at once is bounded: a family of many groups is opened in several rounds, with the same links."""
    monkeypatch.setattr(jaccard_groups, "GROUP_NODES", 4)
    monkeypatch.setattr(jaccard_groups, "ROUND_SHINGLES", 1, raising=False)
    _, rounds = opened(monkeypatch)
    r = random.Random(12)
    base = story(2, 150).split()
    rows = []
    for i in range(60):
        copy = list(base)
        for _ in range(r.randint(1, 5)):
            copy[r.randrange(150)] = f"e{r.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    got = {x.id: x.component for x in jaccard_groups.jaccard_components(documents(spark, rows), 3, 90, 100).collect()}
    assert got == dict(enumerate(jaccard_labels([shingle_set(t, 3) for _, t in rows], 90, 100)))
    assert len(rounds) > 2


def test_shared_tokens_have_two_nodes(spark):
    """Each token of two nodes or more comes with all of them, and no other token; copies count once."""
    rows = [*families(5, 12), *families(5, 12)]
    rule = jaccard_groups.Schemes(80, 100)
    values, at = jaccard_groups.shingle_sets(pa.RecordBatch.from_pydict({"text": sorted({t for _, t in rows})}), "text", 5)
    tokens, of, _ = jaccard_groups.set_tokens(values, at, rule)
    nodes = {}
    for token, node in zip(tokens.view(np.int64).tolist(), jaccard_groups.set_nodes(values, at)[of].tolist()):
        nodes.setdefault(token, set()).add(node)
    want = Counter((token, node, min(all_)) for token, all_ in nodes.items() if len(all_) > 1 for node in all_)
    got = Counter((x.token, x.node, x.owner) for x in jaccard_groups.shared_tokens(documents(spark, rows), rule, 5, "text").collect())
    assert got == want and want


def test_odd_documents(spark):
    rows = odd_texts()
    got = jaccard_groups.jaccard_components(documents(spark), 3, 90, 100).collect()
    sets = [shingle_set(t, 3) for _, t in rows]
    labels = jaccard_labels(sets, 90, 100)
    least = {g: min((i for (i, _), x in zip(rows, labels) if x == g and i is not None), default=None) for g in labels}
    want = Counter((i, len(s), least[g] if s else i) for (i, _), s, g in zip(rows, sets, labels))
    assert Counter((r.id, r.n_shingles, r.component) for r in got) == want


def test_no_documents(spark):
    assert jaccard_groups.jaccard_components(documents(spark, [])).count() == 0


def test_linked_sets_share_the_tokens_they_must():
    """Pairs right at the threshold, of all sizes and around class borders."""
    rule, r = jaccard_groups.Schemes(90, 100), np.random.default_rng(4)
    for n in [*range(1, 130), 300, 1000]:
        for _ in range(3):
            both = r.integers(1, 1 << 62, n).astype(np.uint64)
            extra = n * 100 // 90 - n
            left = int(r.integers(0, extra + 1))
            new = r.integers(1, 1 << 62, extra).astype(np.uint64)
            pair = [np.concatenate([both, new[:left]]), np.concatenate([both, new[left:]])]
            values, at = distinct(np.concatenate(pair), np.array([0, len(pair[0]), len(pair[0]) + len(pair[1])]))
            sizes = np.diff(at)
            sides, need = [set(), set()], []
            for scheme in (rule.of(sizes)[0], *rule.both(sizes)):
                tokens, ends, least = jaccard_groups.part_tokens(values, at, scheme, rule)
                need.append(np.where(scheme >= 0, least, 1 << 30))
                for k in (0, 1):
                    sides[k] |= set(tokens[ends[k] : ends[k + 1]].tolist())
            assert len(sides[0] & sides[1]) >= np.min(need, axis=0).max() >= 1, n


def test_components(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 90), (90, 95)] + [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(40)]
    got = {x.node: x.label for x in components(staged(spark.createDataFrame(edges, "a long, b long"), "edges")).collect()}
    up = {n: n for e in edges if e[0] != e[1] for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and up[a] != up[b]:
                up[a] = up[b] = min(up[a], up[b])
                changed = True
    assert got == up


def test_components_of_two_graphs(spark):
    rows = [(0, 1, 2), (0, 3, 4), (1, 2, 3), (1, 4, 3), (1, 9, 8)]
    found = components(staged(spark.createDataFrame(rows, "g int, a long, b long"), "edges"), by=("g",)).collect()
    assert {(x.g, x.node, x.label) for x in found} == {(0, 1, 1), (0, 2, 1), (0, 3, 3), (0, 4, 3), (1, 2, 2), (1, 3, 2), (1, 4, 2), (1, 8, 8), (1, 9, 8)}


def test_roots_of_a_forest(spark):
    r = random.Random(8)
    parents = {b: r.randrange(b) if b % 7 else b - 1 for b in range(1, 300) if b % 50} | {b: b - 1 for b in range(400, 460)}
    found = {x.node: x.label for x in roots(staged(spark.createDataFrame([(a, b) for b, a in parents.items()], "a long, b long"), "forest")).collect()}
    want = {}
    for b in sorted(parents):
        want[b] = want.get(parents[b], parents[b])
    assert found == want


def test_labels_renamed_by_a_graph_of_labels(spark):
    labels = spark.createDataFrame([(1, 1), (2, 1), (5, 4), (4, 4)], "node long, label long")
    joined = spark.createDataFrame([(1, 1), (4, 1), (8, 8), (9, 8)], "node long, label long")
    rows = lambda how: {tuple(r) for r in onward(labels, joined, how).collect()}
    assert rows("left") == rows("inner") == {(1, 1), (2, 1), (5, 1), (4, 1), (8, 8), (9, 8)}
    some = joined.where("node > 1")
    assert {tuple(r) for r in onward(labels, some).collect()} == {(1, 1), (2, 1), (5, 1), (4, 1), (8, 8), (9, 8)}
    assert {tuple(r) for r in onward(labels, some, "inner").collect()} == {(5, 1), (4, 1), (8, 8), (9, 8)}


def test_many_partitions_make_few_jobs_and_files(spark):
    """A filter comes to the driver by one job, and rounds over small tables are written in few files."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    last = lambda: max(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    try:
        for k, v in zip(before, ("100", "false")):
            spark.conf.set(k, v)
        places = spark.range(0, 1 << 23, 1 << 14).select(F.col("id").alias("p"))
        places.count()
        start = last()
        table = jaccard_groups.bit_filter(places, 1 << 23)
        places.count()
        assert last() - start < 10
        assert np.flatnonzero(table).tolist() == list(range(0, 1 << 20, 1 << 11))
        edges = staged(spark.range(2000).select(F.col("id").alias("a"), (F.col("id") + 5000).alias("b")), "edges")
        assert len(components(edges).inputFiles()) <= LEAST_FILES
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def brute_leaks(docs, items, least=0.8):
    def shingles(text):
        import re

        w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
        return w, [tuple(w[i : i + 5]) for i in range(len(w) - 4)]

    out = {}
    for i, text in docs:
        w, sh = shingles(text)
        for k, item in items:
            iw, ish = shingles(item)
            runs = ish or ([tuple(iw)] if iw else [])
            mine = sh if ish else [tuple(w[j : j + len(iw)]) for j in range(len(w) - len(iw) + 1)]
            best = None
            for j in range(len(mine) - len(runs) + 1) if runs else ():
                a, b = Counter(mine[j : j + len(runs)]), Counter(runs)
                both = sum((a & b).values())
                alike = both / (2 * len(runs) - both)
                if alike >= least and (best is None or alike > best[1]):
                    best = (j, alike)
            if best:
                out[i, k] = best
    return out


def test_leaks_equal_all_windows(spark):
    r = random.Random(6)
    items = [(k, story(100 + k, r.choice((3, 6, 20, 45, 60, 90)))) for k in range(24)]
    items += [(24, None), (25, ""), (26, "...!"), (27, items[3][1])]
    docs = []
    for i in range(120):
        w = [f"d{r.randrange(10**6)}" for _ in range(r.randint(0, 200))]
        if i % 2:
            passage = items[r.randrange(24)][1].split()
            for _ in range(r.randint(0, 2)):
                passage[r.randrange(len(passage))] = "changed"
            if i % 3 == 0:
                passage = [x.upper() + "!!" for x in passage]
            k = r.randint(0, len(w))
            w[k:k] = passage
        docs.append((i, " ".join(w)))
    docs += [(200, None), (201, ""), (None, "nothing to see")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = brute_leaks(docs, items)
    for at_once in (1024, 5):
        got = decontamination.leaks(documents(spark, docs), benchmark, items_at_once=at_once).collect()
        assert {(x.doc_id, x.item_id): (x.start, pytest.approx(x.similarity)) for x in got} == want
        clean = decontamination.decontaminate(documents(spark, docs), benchmark, items_at_once=at_once)
        assert clean.columns == documents(spark, []).columns
        dirty = {i for i, _ in want}
        assert Counter(x.doc_id for x in clean.collect()) == Counter(i for i, _ in docs if i not in dirty)
    assert len(want) > 20


def test_no_benchmark_or_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.leaks(documents(spark), none).count() == 0
    assert decontamination.decontaminate(documents(spark), none).count() == len(odd_texts())
    some = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert decontamination.leaks(documents(spark, []), some).count() == 0


def test_one_row_per_needed_set(spark):
    """Copies of a set that all pass the bit filter, here by their id, give one row."""
    docs = documents(spark, [(i % 4, story(i % 4, 60)) for i in range(80)])
    rule = jaccard_groups.Schemes(80, 100)
    owners = jaccard_groups.shared_tokens(docs, rule, 3, "text")
    sets = staged(jaccard_groups.document_sets(docs, owners, rule, 3, "doc_id", "text", []), "documents")
    nodes = sets.select("node").distinct()
    got = [r.node for r in jaccard_groups.needed_sets(docs, sets, nodes, 3, "doc_id", "text").collect()]
    assert len(got) == len(set(got)) == 4


def test_items_longer_than_the_document(spark):
    """A document that is an item short of some words is one window; all pairs, compared by hand."""
    item = [f"w{k}" for k in range(24)]
    twice = ("a b c d e f g " * 5).split()
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(twice)), (3, "one two three")], "item_id long, text string")
    docs = [(10 + n, " ".join(w[:n])) for w in (item,) for n in range(16, 25)] + [(50, " ".join(item[2:])), (51, " ".join(twice[:-2])), (52, " ".join(item[:11] + item[13:])), (53, "one two"), (54, "w1")]
    want = {}
    for d, text in docs:
        for i, w in ((1, item), (2, twice)):
            one, two = (Counter(tuple(x[k : k + 5]) for k in range(len(x) - 4)) for x in (text.split(), w))
            alike = sum((one & two).values()) / sum((one | two).values())
            if alike >= 0.8:
                want[d, i] = (0, len(text.split()), pytest.approx(alike))
    assert {d for d, _ in want} == {30, 31, 32, 33, 34, 50, 51}
    got = decontamination.leaks(documents(spark, docs), benchmark).collect()
    assert {(x.doc_id, x.item_id): (x.start, x.n_words, x.similarity) for x in got} == want
    clean = decontamination.decontaminate(documents(spark, docs), benchmark)
    assert {x.doc_id for x in clean.collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_index_returns_all_within_the_radius():
    r = np.random.default_rng(8)
    runs = [r.integers(1, 1 << 62, 20).astype(np.uint64) for _ in range(40)]
    items = decontamination.Items(list(range(40)), runs, np.full(40, 24), 19)
    prints = r.integers(0, 1 << 62, 200).astype(np.uint64)
    prints[:80] = np.repeat(items.prints, 2)
    for k in range(80):
        for bit in r.choice(64, k % 24, replace=False):
            prints[k] ^= np.uint64(1) << np.uint64(bit)
    window, item = items.within(prints, 24)
    want = {(w, i) for w in range(200) for i in range(40) if bin(int(prints[w] ^ items.prints[i])).count("1") <= 19}
    assert set(zip(window.tolist(), item.tolist())) == want
    assert words("A b") == ["a", "b"]
