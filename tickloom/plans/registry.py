"""Registry of queries: the Spark function, its output columns and a check in plain SQL.

A column list such as ``"pair date:d close:4 n:l"`` names the output of both sides and
how a value leaves the engine: ``d`` date and ``t`` time as text, ``l`` bigint, ``i`` int,
``b`` boolean, a digit rounds a double (the last bits of a sum depend on its order; the
nudge keeps exact decimal halves, such as a mean of 32 prices, on one side for both).
"""

import re
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import functions as F

from tickloom.plans.inputs import SQL_VIEWS

REGISTRY = {}
NUDGE = 1e-9


@dataclass(frozen=True)
class Query:
    run: Callable
    columns: str
    sql: str | None


def query(name, columns, sql=None):
    def add(run):
        assert name not in REGISTRY, name
        REGISTRY[name] = Query(run, columns, sql)
        return run

    return add


def _parsed(columns):
    for item in columns.split():
        name, _, kind = item.partition(":")
        yield name, kind


def shown(df, columns):
    def render(name, kind):
        c = F.col(name)
        if kind == "d":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind == "t":
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind in ("l", "i", "b"):
            c = c.cast({"l": "long", "i": "int", "b": "boolean"}[kind])
        elif kind:
            c = F.round(c.cast("double") + NUDGE, int(kind))
        return c.alias(name)

    return df.select(*[render(*p) for p in _parsed(columns)])


def shown_sql(sql, columns):
    def render(name, kind):
        forms = {
            "": "{0}",
            "d": "strftime({0}, '%Y-%m-%d')",
            "t": "strftime({0}, '%Y-%m-%d %H:%M:%S')",
            "l": "CAST({0} AS BIGINT)",
            "i": "CAST({0} AS INTEGER)",
            "b": "CAST({0} AS BOOLEAN)",
        }
        form = forms.get(kind, f"round(CAST({{0}} AS DOUBLE) + {NUDGE}, {kind})")
        return f"{form.format(name)} AS {name}"

    picked = ", ".join(render(*p) for p in _parsed(columns))
    body = f"SELECT {picked} FROM (\n{sql.strip()}\n) AS result"
    needed = _views_of(sql)
    if not needed:
        return body
    head = ",\n".join(f"{v} AS ({SQL_VIEWS[v]})" for v in SQL_VIEWS if v in needed)
    return f"WITH RECURSIVE {head}\n{body}"


def _views_of(sql, seen=None):
    seen = set() if seen is None else seen
    for v, text in SQL_VIEWS.items():
        if v not in seen and re.search(rf"\b{v}\b", sql):
            seen.add(v)
            _views_of(text, seen)
    return seen


def queries():
    def bind(q):
        return lambda spark, sf_dir: shown(q.run(spark, sf_dir), q.columns)

    return {n: bind(q) for n, q in REGISTRY.items()}


def oracle_sql():
    return {n: shown_sql(q.sql, q.columns) for n, q in REGISTRY.items() if q.sql}
