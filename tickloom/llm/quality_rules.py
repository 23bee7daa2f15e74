"""Quality rules that vote, weighted by weak supervision instead of all having to pass.

Every rule votes to keep (1) or to drop (-1) a text, or abstains (0). Expectation-maximisation over the
table of vote patterns (at most 3 ** rules rows, whatever the corpus) estimates how often each rule gives
each vote on good and on bad texts and how many texts are good; a text's posterior probability of being
good decides. Everything on the rows is SQL functions: words, 8-word windows and lines are arrays of one
row, so no text is ever shuffled; a row takes some 200 bytes of memory per word while it is worked on.

Cases: NULL is a text without words; an empty or word-free text has all counts zero and fails the base
rules; repeated rows get equal results; NULL ids are carried; an empty table gives no rows; extra columns
are ignored by `judge` and carried by `keep_good`, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.staging import staged

#: White space in a Java and in an RE2 pattern.
GAP = r"\x20\x09-\x0D"
WINDOW = 8
STEPS = 30
#: Chance of votes -1, 0 and 1 to start from, on good and on bad texts.
START = {True: (0.02, 0.25, 0.73), False: (0.5, 0.2, 0.3)}
#: Texts added to the bad ones in each round with START's chances, as a share of all: where hardly any text
#: is bad, "bad" then still means texts that rules vote to drop, and no odd kind of good ones.
HELD = 0.02
#: Condition for a vote to drop, and to keep, in whole numbers; the same text is valid in Spark and in DuckDB.
RULES = {
    "symbols": ("10 * n_symbols > n_words", "n_symbols = 0"),
    "signs": ("5 * n_signs > 4 * n_words", "5 * n_signs < 2 * n_words"),
    "capitals": ("10 * n_capitals > 3 * word_chars", "10 * n_capitals < word_chars"),
    "repetition": ("5 * n_repeat_words > n_words", "20 * n_repeat_words < n_words"),
    "lines": ("10 * n_dup_lines > 3 * n_lines", "n_dup_lines = 0"),
    "word_length": ("word_chars > 10 * n_words or 2 * word_chars < 5 * n_words", "2 * word_chars > 7 * n_words and word_chars < 8 * n_words"),
    "single_signs": ("4 * n_single > n_words", "20 * n_single < 3 * n_words"),
}
VOTES = tuple(f"v_{name}" for name in RULES)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_signs", "n_capitals", "n_single")
BASE_FAILED = "n_words < 20 or 100 * n_repeat_words > 30 * n_words"


def _bind(value: str, name: str, body: str) -> str:
    """`body` with `name` worked out once a row."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _repeated(words: str) -> str:
    """Words inside 8-word windows that occur twice or more: repeated windows in order, each up to the next one's start."""
    ordered = "sort_array(transform(g, (x, i) -> struct(x as h, i as p)))"
    twice = "sort_array(filter(transform(s, (e, i) -> if(get(s, i - 1).h = e.h or get(s, i + 1).h = e.h, e.p, null)), p -> p is not null))"
    covered = f"aggregate(transform(f, (p, i) -> least({WINDOW}, coalesce(get(f, i + 1) - p, {WINDOW}))), 0, (a, b) -> a + b)"
    found = f"case when size(array_distinct(g)) = size(g) then 0 else {_bind(ordered, 's', _bind(twice, 'f', covered))} end"
    windows = f"transform(sequence(1, size(h) - {WINDOW - 1}), i -> xxhash64(slice(h, i, {WINDOW})))"
    hashed = f"transform({words}, w -> xxhash64(w))"
    return f"case when size({words}) <= {WINDOW} then 0 else {_bind(hashed, 'h', _bind(windows, 'g', found))} end"


def with_counts(docs: DataFrame, text_col: str, out: str) -> DataFrame:
    """`docs` and a struct column `out` of COUNTS and VOTES."""
    text, words, lines = (f"`{out}_{x}`" for x in ("text", "words", "lines"))
    docs = docs.withColumn(f"{out}_text", F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    docs = docs.withColumn(f"{out}_words", F.expr(rf"array_remove(split({text}, '[\\x20\\x09-\\x0D]+'), '')"))
    docs = docs.withColumn(f"{out}_lines", F.expr(rf"filter(split({text}, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')"))
    counts = {
        "n_words": f"size({words})",
        "word_chars": rf"char_length({text}) - regexp_count({text}, '[\\x20\\x09-\\x0D]')",
        "n_symbols": f"regexp_count({text}, '[#*$%&|<>]')",
        "n_dup_lines": f"size({lines}) - size(array_distinct({lines}))",
        "n_repeat_words": _repeated(words),
        "n_lines": f"size({lines})",
        "n_signs": rf"regexp_count({text}, '[!-/:-@\\[-`{{-~]')",
        "n_capitals": rf"regexp_count({text}, '\\p{{Lu}}')",
        "n_single": f"size(filter({words}, w -> char_length(w) = 1))",
    }
    docs = docs.withColumn(out, F.struct(*[F.expr(counts[c]).cast("long").alias(c) for c in COUNTS]))
    votes = [F.expr(_vote(drop, keep, f"`{out}`.")).alias(v) for v, (drop, keep) in zip(VOTES, RULES.values(), strict=True)]
    docs = docs.withColumn(out, F.struct(*[F.col(f"`{out}`.{c}").alias(c) for c in COUNTS], *votes))
    return docs.drop(*(f"{out}_{x}" for x in ("text", "words", "lines")))


def _vote(drop: str, keep: str, prefix: str = "") -> str:
    for c in COUNTS:
        drop, keep = (x.replace(c, prefix + c) for x in (drop, keep))
    return f"case when {prefix}n_words = 0 then 0 when {drop} then -1 when {keep} then 1 else 0 end"


def fit(patterns: list[tuple[tuple[int, ...], int]]) -> dict:
    """Estimate, by STEPS rounds, `good` (share of good texts) and per class and rule the chance of each vote.

    It starts from START; one is added to every count, and HELD to those of bad texts.
    """
    votes = (-1, 0, 1)
    good, total = 0.8, sum(n for _, n in patterns)
    chance = {side: [list(START[side]) for _ in VOTES] for side in START}
    for _ in range(STEPS):
        sums = {True: [[1.0] * 3 for _ in VOTES], False: [[1 + HELD * total * c for c in START[False]] for _ in VOTES]}
        goods = 1.0
        for pattern, n in patterns:
            odds = math.log(good / (1 - good))
            for rule, vote in enumerate(pattern):
                odds += math.log(chance[True][rule][vote + 1] / chance[False][rule][vote + 1])
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
            goods += n * p
            for rule, vote in enumerate(pattern):
                sums[True][rule][vote + 1] += n * p
                sums[False][rule][vote + 1] += n * (1 - p)
        good = goods / (total + 2)
        chance = {side: [[x / sum(row) for x in row] for row in sums[side]] for side in sums}
    return {"good": good, "weights": {(v, vote): math.log(chance[True][r][vote + 1] / chance[False][r][vote + 1]) for r, v in enumerate(VOTES) for vote in votes}}


def posterior(model: dict, prefix: str = "") -> Column:
    odds = F.lit(math.log(model["good"] / (1 - model["good"])))
    for v in VOTES:
        case = F.lit(model["weights"][v, 0])
        for vote in (-1, 1):
            case = F.when(F.col(prefix + v) == vote, model["weights"][v, vote]).otherwise(case)
        odds = odds + case
    return 1 / (1 + F.exp(-odds))


def _fitted(counted: DataFrame, prefix: str = "") -> dict:
    found = counted.groupBy(*[F.col(prefix + v).alias(v) for v in VOTES]).agg(F.count("*").alias("n")).collect()  # at most 3 ** len(RULES) rows
    return fit(sorted((tuple(r[v] for v in VOTES), r["n"]) for r in found))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, COUNTS, VOTES, base_failed, posterior and kept of every row."""
    counted = with_counts(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", "_c")
    counted = staged(counted.select("doc_id", "_c.*"), "counts")
    out = counted.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("posterior", posterior(_fitted(counted)))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, that the base rules pass and whose posterior is at least a half."""
    out = "_counts"
    while any(c.startswith(out) for c in docs.columns):
        out = f"_{out}"
    counted = staged(with_counts(docs, text_col, out), "judged")
    failed = BASE_FAILED
    for c in COUNTS:
        failed = failed.replace(c, f"`{out}`.{c}")
    good = posterior(_fitted(counted, f"{out}."), f"{out}.") >= 0.5
    return counted.where(~F.expr(failed) & good).select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the base counts, base_failed and kept of every document."""
    judged = judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return judged.select("doc_id", *COUNTS[:5], "base_failed", "kept")


def _oracle() -> str:
    """The same counts, votes and estimation in DuckDB; the rounds are a recursive query over the pattern table."""
    w = WINDOW
    start = [0.8] + [x for side in (True, False) for _ in VOTES for x in START[side]]
    size = len(VOTES)
    at = lambda good, rule, vote: 2 + (0 if good else 3 * size) + 3 * rule + vote
    odds = "ln(s[1] / (1 - s[1]))" + "".join(f" + ln(s[{at(True, r, 0)} + {v} + 1] / s[{at(False, r, 0)} + {v} + 1])" for r, v in enumerate(VOTES))
    held = lambda good, vote: 0 if good else HELD * START[False][vote + 1]
    chance = lambda good, r, vote: f"(1 + {held(good, vote)} * sum(n) + sum(case when {VOTES[r]} = {vote} then n * {'p' if good else '(1 - p)'} else 0 end)) / (3 + {0 if good else HELD} * sum(n) + sum(n * {'p' if good else '(1 - p)'}))"
    new = ["(1 + sum(n * p)) / (2 + sum(n))"] + [chance(good, r, vote) for good in (True, False) for r in range(size) for vote in (-1, 0, 1)]
    votes = ", ".join(f"{_vote(*RULES[v[2:]])} as {v}" for v in VOTES)
    return rf"""
with recursive texts as (
  select doc_id, coalesce(text, '') as t from documents
), cut as (
  select doc_id, t, regexp_extract_all(t, '[^{GAP}]+') as w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{GAP}]')) as l from texts
), runs as (
  select doc_id, t, w, l, list_transform(range(1, len(w) - {w - 2}), lambda i: array_to_string(w[i:i + {w - 1}], ' ')) as g from cut
), twice as (
  select doc_id, count(*) as n from (
    select distinct doc_id, p + k as word from (
      select doc_id, p, count(*) over (partition by doc_id, x) as times from (
        select doc_id, unnest(g) as x, generate_subscripts(g, 1) as p from runs)
    ), range({w}) as r(k) where times > 1)
  group by doc_id
), counts as (
  select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(n, 0) as n_repeat_words, len(l) as n_lines,
    length(regexp_replace(t, '[^!-/:-@\[-`{{-~]', '', 'g')) as n_signs, length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) as n_capitals,
    len(list_filter(w, lambda x: length(x) = 1)) as n_single
  from runs left join twice using (doc_id)
), voted as (select *, {votes} from counts
), patterns as (select {", ".join(VOTES)}, count(*)::double as n from voted group by all
), rounds(k, s) as (
  select 0, [{", ".join(map(str, start))}]::double[]
  union all
  select k + 1, [{", ".join(new)}] from (select k, n, {", ".join(VOTES)}, 1 / (1 + exp(-({odds}))) as p from rounds, patterns where k < {STEPS}) group by k
), model as (select s from rounds where k = {STEPS})
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines,
  n_repeat_words::bigint as n_repeat_words, ({BASE_FAILED}) as base_failed, not ({BASE_FAILED}) and 1 / (1 + exp(-({odds}))) >= 0.5 as kept
from voted, model"""


OP4_SQL = _oracle()
