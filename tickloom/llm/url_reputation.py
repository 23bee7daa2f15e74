"""URL filter: given rules first, else an empirical-Bayes reputation of the host.

Reputation: labelled pages are good or bad. A suffix's share of good pages is shrunk towards the share of
all, a registered domain's towards its suffix's, a host's towards its domain's, each with a beta prior.
A level's strength comes from its own groups: with n_i pages and shares p_i around their parents' means
m_i, sum n_i (p_i - m_i)^2 / (m_i (1 - m_i)) is about G + rho * sum (n_i - 1), and rho = 1 / (strength + 1).
A prior never counts for more than the evidence that its own mean rests on.
A host is blocked only when the upper bound of its posterior, mean plus `z` deviations, is below
`least_good`: a host with few labelled pages takes after its domain and is not blocked by chance.

The registered domain is the label before the longest known public suffix; without one, the last label is
the suffix. Every step is a grouping with a map-side half; the host table is stored before pages are joined
to it, so that a very frequent host's rows are split at run time.

Cases: a NULL url or one without `://` has an empty host and path, fits no rule and is judged as the host
''; pages without label, with a NULL id or with contradicting labels (the worse counts) are defined so;
repeated rows get equal results; without any label all hosts have a share of a half; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.staging import staged

#: (verdict, host, path) of the query's rules.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: In the given tables every site lives below one of these.
SUFFIXES = ("example.com", "example.net", "example.org")
MOST_RULES = 1000
Z, LEAST_GOOD = 1.64, 0.5
LOW, HIGH = 0.001, 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, or NULL. The rules are one expression, hence their bound."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, action).otherwise(verdict)
    return name, verdict


def domain_and_suffix(host: Column, suffixes: tuple[str, ...]) -> tuple[Column, Column]:
    """Registered domain and public suffix; a host that is a suffix is its own domain."""
    suffix = F.substring_index(host, ".", -1)
    for known in sorted(suffixes, key=len):
        suffix = F.when((host == known) | host.endswith(f".{known}"), known).otherwise(suffix)
    before = F.expr("left(_host, greatest(0, length(_host) - length(_suffix) - 1))")
    return F.when(before == "", F.col("_suffix")).otherwise(F.concat_ws(".", F.substring_index(before, ".", -1), F.col("_suffix"))), suffix


def _strength(groups: DataFrame) -> DataFrame:
    """One row: strength of the prior around `m` of groups with n labelled pages, k of them good, before it is held to `e`."""
    some = groups.where("n > 0")
    spread = F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - F.col("m"), 2) / (F.col("m") * (1 - F.col("m"))))
    extra = F.sum("n") - F.count("*")
    rho = F.when(extra > 0, (spread - F.count("*")) / extra).otherwise(LOW)
    return some.agg((1 / F.least(F.lit(HIGH), F.greatest(F.lit(LOW), F.coalesce(rho, F.lit(LOW)))) - 1).alias("strength"))


def _shrunk(strength: float) -> tuple[Column, Column]:
    """Posterior mean, and the evidence it rests on: own pages and the prior's strength."""
    held = F.least(F.lit(strength), F.col("e"))
    return (F.col("k") + held * F.col("m")) / (F.col("n") + held), F.col("n") + held


def reputation(pages: DataFrame, suffixes: tuple[str, ...] = SUFFIXES, z: float = Z) -> DataFrame:
    """host, n_labelled, good (posterior mean), upper (its bound) of every host of `pages` (host, good: boolean or NULL)."""
    hosts = pages.groupBy(F.col("host").alias("_host")).agg(F.count("good").alias("n"), F.coalesce(F.sum(F.col("good").cast("long")), F.lit(0)).alias("k"))
    domain, suffix = domain_and_suffix(F.col("_host"), suffixes)
    hosts = staged(hosts.withColumn("_suffix", suffix).withColumn("_domain", domain), "hosts")
    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")).first()
    level = hosts.groupBy("_suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumns({"m": F.lit((total["k"] + 1) / (total["n"] + 2)), "e": F.lit(total["n"] + 2.0)})
    parts = {"_domain": hosts.groupBy("_suffix", "_domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), "_host": hosts}
    for key, groups in parts.items():
        parent = "_suffix" if key == "_domain" else "_domain"
        mean, evidence = _shrunk(_strength(level).first()[0])
        means = level.select(*{"_suffix", parent}, mean.alias("m"), evidence.alias("e"))
        level = staged(groups.join(means, sorted({"_suffix", parent})), "level")
    good, evidence = _shrunk(_strength(level).first()[0])
    upper = good + z * F.sqrt(good * (1 - good) / (evidence + 1))
    return staged(level.select(F.col("_host").alias("host"), F.col("n").alias("n_labelled"), good.alias("good"), upper.alias("upper")), "reputation")


def judge_urls(pages: DataFrame, labels: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, suffixes: tuple[str, ...] = SUFFIXES, least_good: float = LEAST_GOOD) -> DataFrame:
    """page_id, host, path, rule, verdict, good of every page. `labels`: page_id, good."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = labels.groupBy("page_id").agg(F.min("good").alias("good"))
    found = reputation(rows.join(known, "page_id", "left").select("host", "good"), suffixes)
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("upper") < least_good, "block").otherwise("allow")
    return rows.join(found, "host").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), F.round("good", 6).alias("good"))


def op6_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict, good. A page is labelled by the row of `labels` with its number: good if quality 1 and not toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), labels.select(F.col("doc_id").alias("page_id"), good.alias("good")))


def _oracle() -> str:
    fits = [f"(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')" for _, h, p in RULES]
    longest = sorted(range(len(RULES)), key=lambda i: -len(RULES[i][1] + RULES[i][2]))
    rule = " ".join(f"when {fits[i]} then '{RULES[i][1]}{RULES[i][2]}'" for i in longest)
    verdict = " ".join(f"when {fits[i]} then '{RULES[i][0]}'" for i in longest)
    suffix = " ".join(f"when host = '{s}' or ends_with(host, '.{s}') then '{s}'" for s in sorted(SUFFIXES, key=len, reverse=True))
    strength = lambda t: (
        f"(select 1 / least({HIGH}, greatest({LOW}, coalesce(case when sum(n) - count(*) > 0 then (sum(n * pow(k / n - m, 2) / (m * (1 - m))) - count(*)) / (sum(n) - count(*)) else {LOW} end, {LOW}))) - 1 from {t} where n > 0)"
    )
    return rf"""
with urls as (
  select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), rows_ as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from urls
), known as (
  select doc_id as page_id, min((quality = 1 and toxic = 0)::int)::double as good from labels group by 1
), hosts as (
  select host, count(good) as n, coalesce(sum(good), 0) as k, case {suffix} else split_part(host, '.', -1) end as suffix
  from rows_ left join known using (page_id) group by host
), named as (
  select *, left(host, greatest(0, length(host) - length(suffix) - 1)) as front,
    case when front = '' then suffix else split_part(front, '.', -1) || '.' || suffix end as domain from hosts
), level1 as (
  select suffix, sum(n) as n, sum(k) as k, (select (coalesce(sum(k), 0) + 1) / (coalesce(sum(n), 0) + 2) from named) as m,
    (select coalesce(sum(n), 0) + 2.0::double from named) as e from named group by suffix
), mean1 as (
  select suffix, (k + least(s, e) * m) / (n + least(s, e)) as m, n + least(s, e) as e from level1, (select {strength("level1")} as s)
), level2 as (
  select suffix, domain, d.n, d.k, m, e from (select suffix, domain, sum(n) as n, sum(k) as k from named group by suffix, domain) d join mean1 using (suffix)
), mean2 as (
  select suffix, domain, (k + least(s, e) * m) / (n + least(s, e)) as m, n + least(s, e) as e from level2, (select {strength("level2")} as s)
), level3 as (
  select host, n, k, m, e from named join mean2 using (suffix, domain)
), mean3 as (
  select host, (k + least(s, e) * m) / (n + least(s, e)) as good, n + least(s, e) as e from level3, (select {strength("level3")} as s)
)
select page_id, host, path, case {rule} end as rule,
  coalesce(case {verdict} end, case when good + {Z} * sqrt(good * (1 - good) / (e + 1)) < {LEAST_GOOD} then 'block' else 'allow' end) as verdict,
  round(good, 6) as good
from rows_ join mean3 using (host)"""


OP6_SQL = _oracle()
