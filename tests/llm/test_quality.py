"""Rules, classifier, language model and URL verdicts."""

import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import ppm, quality_pu, quality_rules, url_reputation
from tickloom.llm.workers import ship

from .cases import documents, odd_texts, story, words

SF = "/root/testdata/sf0.01"


def test_rules_equal_sql_on_odd_documents(spark):
    rows = [(n, t) for n, (_, t) in enumerate(odd_texts()) if t is None or len(t) < 50_000]
    rows += [(100 + n, t) for n, t in enumerate(["a b c d e f g h a b c d e f g h x", "a " * 40, "x\n\nx\n x\n", "AB CD|EF *** $ % &<>", "a b c d e f g h i a b c d e f g h"])]
    got = quality_rules.judge(documents(spark, rows)).select("doc_id", *quality_rules.COUNTS[:5], "base_failed", "kept").collect()
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    assert sorted(map(tuple, got)) == sorted(con.execute(quality_rules.OP4_SQL).fetchall())


def test_repeated_words_by_hand(spark):
    rows = [(1, "a b c d e f g h a b c d e f g h"), (2, "z a b c d e f g h y a b c d e f g h w"), (3, "a " * 12), (4, "a b c d e f g h i")]
    got = {r.doc_id: r.n_repeat_words for r in quality_rules.judge(documents(spark, rows)).collect()}
    assert got == {1: 16, 2: 16, 3: 12, 4: 0}


def test_rules_keep_rows_and_columns(spark):
    docs = documents(spark)
    kept = quality_rules.keep_good(docs)
    assert kept.schema == docs.schema
    judged = quality_rules.judge(docs).where("kept").collect()
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in judged)
    assert quality_rules.keep_good(documents(spark, [])).count() == 0


def test_rules_outvote(spark):
    """One vote to drop among votes to keep is not enough; several are."""
    ok, bad = (1,) * 7, (-1, -1, 1, 1, 1, 1, 1)
    model = quality_rules.fit([(ok, 900), (bad, 100), ((1, 1, 1, 1, -1, 1, 1), 2)])
    odds = lambda p: math.log(model["good"] / (1 - model["good"])) + sum(model["weights"][v, x] for v, x in zip(quality_rules.VOTES, p))
    assert odds(ok) > 0 > odds(bad) and odds((1, 1, 1, 1, -1, 1, 1)) > 0
    assert 0.85 < model["good"] < 0.95


def test_classifier_on_held_out_labels(spark):
    got = quality_pu.op10_quality_pu(spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    held = got[got.held_out].merge(labels, on="doc_id")
    good, bad = (held[held.quality == q].score.to_numpy() for q in (1, 0))
    assert (good[:, None] > bad[None, :]).mean() > 0.95
    assert (held.predicted == held.quality).mean() > 0.93
    assert (good >= 0.5).mean() > 0.98
    assert ((got.predicted == 1) == (got.score >= 0.5)).all()


def test_classifier_odd_cases(spark):
    ship(spark)
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality_pu.train(docs, none)
    assert {r.score for r in quality_pu.score(docs, model).collect()} == {0.5}
    assert quality_pu.keep_good(docs, model).schema == docs.schema
    torn = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (7, 1), (9, 1), (None, 1)], "doc_id long, quality int")
    scored = quality_pu.score(docs, quality_pu.train(docs, torn)).collect()
    assert len(scored) == len(odd_texts()) and all(0 <= r.score <= 1 for r in scored)
    empty = documents(spark, [])
    assert quality_pu.score(empty, quality_pu.train(empty, torn)).count() == 0


def test_features_do_not_depend_on_the_batch():
    import pyarrow as pa

    texts = [t for _, t in odd_texts() if t is None or len(t) < 50_000]
    whole = quality_pu.features(pa.array(texts, pa.string()))
    alone = np.concatenate([quality_pu.features(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(whole, alone)


def test_prior_is_estimated():
    r = np.random.default_rng(5)
    p = np.column_stack([r.normal(2, 1, (3000, 3)), np.ones(3000)])
    u = np.column_stack([np.concatenate([r.normal(2, 1, (4200, 3)), r.normal(-2, 1, (1800, 3))]), np.ones(6000)])[r.permutation(6000)]
    w = quality_pu.against(p[::2], u[::2])
    marks = np.sort(p[1::2] @ w)
    below = np.array([*(int((u @ w < m).sum()) for m in marks), len(u)])
    assert quality_pu.prior_of(marks, below) == pytest.approx(0.7, abs=0.05)


def plain_risk(w, p, u, prior):
    """The non-negative risk term by term: (whole, its second part)."""
    dot = lambda x: sum(a * b for a, b in zip(w, x))
    loss = lambda z: math.log1p(math.exp(-z))
    mean = lambda xs: sum(xs) / len(xs)
    positive = prior * mean([loss(dot(x)) for x in p])
    negative = mean([loss(-dot(x)) for x in u]) - prior * mean([loss(-dot(x)) for x in p])
    return positive + negative, negative


@pytest.mark.parametrize("seed", range(6))
def test_steps_follow_the_risk(seed):
    """The step equals differences of the plainly written risk, and turns back where its second part is below zero."""
    r = np.random.default_rng(seed)
    p, u, w = r.normal(1, 1, (30, 4)), r.normal(0, 1, (50, 4)), r.normal(0, 1 + seed, 4)
    prior = 0.3 + 0.1 * seed
    _, second = plain_risk(w, p, u, prior)
    got = quality_pu.risk_step(w, p, u, prior)
    for k in range(4):
        e = np.eye(4)[k] * 1e-6
        up, down = plain_risk(w + e, p, u, prior), plain_risk(w - e, p, u, prior)
        want = -(up[1] - down[1]) / 2e-6 if second < 0 else (up[0] - down[0]) / 2e-6 + quality_pu.RIDGE * w[k]
        assert got[k] == pytest.approx(want, abs=1e-5)


def test_shares_below_marks_cover_all_rows(spark):
    """Counts over all rows, by scores worked out on the driver."""
    import pyarrow as pa

    ship(spark)
    docs = documents(spark)
    r = np.random.default_rng(2)
    size = quality_pu.BUCKETS + quality_pu.RATIOS
    mean, scale, w = np.zeros(size), np.ones(size), r.normal(0, 1, size + 1).astype(np.float32)
    scores = quality_pu.features(pa.array([t for _, t in odd_texts()], pa.string())) @ w[:-1] + w[-1]
    marks = np.sort(scores.astype(np.float64))[::3] + 1e-4
    got = quality_pu._below(docs.select("text"), mean, scale, w, marks)
    assert got.tolist() == [*(int((scores < m).sum()) for m in marks), len(scores)]


def test_one_row_for_a_third_of_all(spark):
    """A repeated labelled row is learnt once, and all its copies are scored alike."""
    rows = [(4, story(1, 50))] * 300 + [(i, story(i, 40)) for i in range(10, 400)]
    labels = spark.createDataFrame([(4, 1), *((i, 1) for i in range(10, 200))], "doc_id long, quality int")
    docs = documents(spark, rows)
    scored = quality_pu.score(docs, quality_pu.train(docs, labels)).collect()
    assert len(scored) == len(rows) and len({r.score for r in scored if r.doc_id == 4}) == 1


def brute_scores(rows):
    """The language model by plain dictionaries."""
    learn = [t or "" for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    counts = Counter(w for t in learn for w in words(t)) + Counter({None: len(learn)})
    total, kinds = sum(counts.values()), len(counts)
    follow = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
    pad = bytes([ppm.START]) * ppm.ORDER
    for t in learn:
        b = pad + t.encode() + bytes([ppm.END])
        for p in range(ppm.ORDER, len(b)):
            for o in range(ppm.ORDER + 1):
                follow[o][b[p - o : p]][b[p]] += 1
    out = []
    for i, t in rows:
        tokens = [*words(t), None]
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in tokens)
        b, score = pad + (t or "").encode() + bytes([ppm.END]), 0.0
        for p in range(ppm.ORDER, len(b)):
            out_of = set()
            for o in range(ppm.ORDER, -1, -1):
                seen = {s: n for s, n in follow[o].get(b[p - o : p], {}).items() if s not in out_of}
                if b[p] in seen:
                    score += math.log10(seen[b[p]] / (sum(seen.values()) + len(seen)))
                    break
                if seen:
                    score += math.log10(len(seen) / (sum(seen.values()) + len(seen)))
                    out_of |= set(seen)
            else:
                score -= math.log10(ppm.SYMBOLS - len(out_of))
        out.append((i, len(tokens), sum(counts[w] > 0 for w in tokens), total, base, score))
    return out


def test_language_model_equals_dictionaries(spark, tmp_path):
    rows = [(i, t) for i, t in odd_texts() if t is None or len(t) < 5_000]
    rows += [(200 + n, f"held out or not {n} {'unheard ' * n}") for n in range(12)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = ppm.op9_ppm_score(spark, str(tmp_path)).collect()
    order = lambda x: (x[0] is None, x[0] or 0, round(x[-1], 4))
    found = sorted([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got], key=order)
    for mine, want in zip(found, sorted(brute_scores(rows), key=order), strict=True):
        assert mine[:4] == want[:4] and mine[4:] == pytest.approx(want[4:])
    assert {r.doc_id: r.held_out for r in got if r.doc_id is not None} == {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows if i is not None}


def test_rare_words_are_joined(spark):
    """With hardly any word sent to the tasks, the counts come from the join and stay the same."""
    docs = documents(spark, [(i, t) for i, t in odd_texts() if t is None or len(t) < 5_000])
    whole, rare = ppm.train(docs), ppm.train(docs, most_words=2)
    assert len(rare[0].words) <= 2 < len(whole[0].words)
    one, two = (sorted((r.n_tokens, r.n_known, round(r.base_score, 6)) for r in ppm.score(docs, *m).collect()) for m in (whole, rare))
    assert one == two


def test_runs_not_held_are_joined(spark):
    """With hardly any run, or none, sent to the tasks, scores still come from all learnt runs."""
    rows = [(i, t) for i, t in odd_texts() if t is None or len(t) < 5_000]
    rows += [(200 + n, f"held out or not {n} {'unheard ' * n}") for n in range(12)] + [(300, "\0" * 9), (301, "\0" * 20)]
    docs = documents(spark, rows)
    want = sorted(r[-1] for r in brute_scores(rows))
    for most in (0, 40):
        model, rare = ppm.train(docs.where(ppm.learnt(F.col("doc_id"))), most_edges=most)
        assert len(model.runs) <= most
        assert sorted(r.score for r in ppm.score(docs, model, rare).collect()) == pytest.approx(want)


def test_bound_on_large_counts(spark):
    """Counts above 65,536 are told apart, and what is sent is bounded among them too."""
    counts = spark.range(100).selectExpr("id as key", "100000 + 1000 * id as n")
    assert 0 < len(ppm._collected(counts, 30)[0]) <= 30


def test_probabilities_sum_to_one(spark):
    model, _ = ppm.train(documents(spark, [(i, t) for i, t in odd_texts() if t and len(t) < 5_000]), most_edges=300)
    for context in (b"\xfe\xfe\xfe\xfe\xfe", b"e qui", b"zzzzz", b"of an"):
        base = int.from_bytes(context, "big") << 8
        symbols = np.array([base | s for s in range(256) if s != ppm.START], np.uint64)
        assert (10 ** model.trie.log10(symbols)).sum() == pytest.approx(1)


def test_language_model_without_documents(spark):
    empty = documents(spark, [])
    model, rare = ppm.train(empty)
    assert ppm.score(empty, model, rare).count() == 0
    r = ppm.score(documents(spark, [(1, "ab")]), model, rare).first()
    assert r.n_known == 0 and r.score == pytest.approx(-3 * math.log10(ppm.SYMBOLS))


URLS = [
    (1, "http://A.Example.COM/de/x?q=1#f"),
    (2, "https://example.net/en/"),
    (3, "https://x.example.net/en"),
    (4, "ftp://shop.net"),
    (5, "http://shop.net/"),
    (6, "http://notexample.com/de/"),
    (7, "http://a.org/fr/b#c"),
    (8, "no scheme"),
    (9, None),
    (10, ""),
    (11, "://"),
    (12, "http://?x"),
    (None, "http://example.com/de/"),
    (13, "http://ÄÖ.org/fr/é?"),
    (1, "http://A.Example.COM/de/x?q=1#f"),
    (14, "http://a.b/c://d.net/"),
]


def test_urls_equal_sql(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in URLS], "page_id long, url string, host string")
    labels = [(1, 0, 0), (1, 1, 0), (2, 1, 0), (5, 0, 1), (7, 1, 0), (9, 0, 0), (None, 0, 0)]
    good = spark.createDataFrame([(i, q == 1 and t == 0) for i, q, t in labels], "page_id long, good boolean")
    got = [tuple(r) for r in url_reputation.judge_urls(pages, good).collect()]
    con = duckdb.connect()
    con.execute("create table pages(page_id bigint, url varchar); create table labels(doc_id bigint, quality int, toxic int)")
    con.executemany("insert into pages values (?, ?)", URLS)
    con.executemany("insert into labels values (?, ?, ?)", labels)
    assert sorted(map(repr, got)) == sorted(map(repr, con.execute(url_reputation.OP6_SQL).fetchall()))
    by_id = {r[0]: r[1:5] for r in got}
    assert by_id[1] == ("a.example.com", "/de/x", "example.com/de/", "block")
    assert by_id[2][2:] == ("example.net/en/", "allow") and by_id[3][2] == "net/" and by_id[4][:3] == ("shop.net", "", None)
    assert by_id[9][:3] == ("", "", None) and by_id[12][:2] == ("", "")


def test_hosts_are_shrunk(spark):
    """A bad host with many pages is blocked; one bad page of an unknown host is not."""
    rows = [(i, f"http://good{i % 20}.example.org/a", True) for i in range(400)]
    rows += [(1000 + i, "http://bad.site.example.org/a", False) for i in range(80)] + [(2000, "http://one.example.org/", False), (2001, "http://new.example.org/", None)]
    pages = spark.createDataFrame([(i, u) for i, u, _ in rows], "page_id long, url string")
    good = spark.createDataFrame([(i, g) for i, _, g in rows if g is not None], "page_id long, good boolean")
    verdicts = {r.host: r.verdict for r in url_reputation.judge_urls(pages, good, rules=()).collect()}
    assert verdicts.pop("bad.site.example.org") == "block" and set(verdicts.values()) == {"allow"}
    assert url_reputation.judge_urls(pages.limit(0), good).count() == 0
    with pytest.raises(ValueError, match="rules"):
        url_reputation.judge_urls(pages, good, rules=(("block", "x", "/"),) * 1001)
