"""The operators that have an SQL check, against it on odd documents."""

from collections import Counter

import duckdb
import pytest

from tickloom.llm import importance, jaccard_groups, jaccard_sql, minhash_bayes

from .cases import documents, odd_texts
from .test_groups import families


def from_sql(sql, docs, benchmark=()):
    con = duckdb.connect()
    for name, rows in (("documents", docs), ("benchmark", benchmark)):
        con.execute(f"create table {name}(doc_id bigint, text varchar)")
        if rows:
            con.executemany(f"insert into {name} values (?, ?)", rows)
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    return [dict(zip(names, r)) for r in found.fetchall()]


@pytest.mark.parametrize("name", ["op8", "op12"])
def test_groups(spark, name):
    rows = odd_texts() + [(100 + i, t) for i, t in families(4, 12)]
    if name == "op8":
        found = jaccard_groups.jaccard_components(documents(spark, rows), 3, 90, 100)
        sql = jaccard_sql.OP8_SQL
    else:
        found = minhash_bayes.near_components(documents(spark, rows), 2, 80, 100)
        sql = jaccard_sql.OP12_SQL
    want = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in from_sql(sql, rows))
    assert Counter((r.id, r.n_shingles, r.component) for r in found.collect()) == want


def test_importance(spark):
    rows = [(i, t) for i, t in odd_texts() if i != 8]  # the SQL is too slow for one very long word
    target = rows[:6]
    found = importance.resample(documents(spark, rows), documents(spark, target)).collect()
    want = from_sql(importance.OP11_SQL, rows, target)
    assert Counter((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in want) == Counter((r.doc_id, r.n_features, r.weight, r.score) for r in found)
    assert sorted(r["rank"] for r in want if r["rank"]) == sorted(r["rank"] for r in found if r["rank"])
