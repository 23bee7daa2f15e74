"""Similarity join on word n-gram sets with a token-group matrix.

Two documents link when den * |A n B| >= num * |A u B|. Documents with one and the same set are one
node from the start. For the others:

1. Tokens. At the threshold, sets of total size s differ in at most k = s (den - num) / (den + num)
   shingles. Shingles are dealt by hash into k + 1 + slack parts; each differing shingle spoils one part,
   so linked sets agree in a known number of parts. A part's content is the token of the matrix. The
   number of parts depends on the size, so sizes fall into classes by a factor of 1.5, and a set within
   reach of a class border also has tokens of a scheme across that border. Common passages don't fill
   token lists, because a token stands for several shingles at once. One shuffle of all tokens finds those of
   two nodes or more; the many tokens of one node are never stored.
2. Groups. A node that shares fewer tokens, with all others together, than it must with any one partner has none and
   goes: most nodes meet others by a few chance tokens only. Each node left joins the node that is the
   smallest of most of its tokens: similar documents come together. Groups
   over a bound are dealt out by hash, so no group grows with the data. Small groups that the matrix finds
   similar are then put together up to the bound, so that a family of documents is in few groups.
3. Matrix. Its rows are (token, group): the union of the group's tokens. Two groups are compared only when
   they share as many tokens as any linked pair across them must.
4. Opening. A task has the shingle sets of two groups (or one). A set whose overlap with the other group's
   union of shingles is below num / den of its size is passed over; the rest are counted exactly. A task
   returns a spanning forest, not pairs. Jobs are opened in rounds of bounded size.
5. Components of all links.

Shingles, sets and nodes are 64-bit hashes. Every step is exact otherwise: nothing is capped or sampled.

Cases: NULL, empty and word-free texts have the empty set and link with nothing, themselves included; texts
with fewer words than a shingle have their whole sequence as one; NULL ids are carried and are no
component's id unless all its ids are NULL; repeated rows and ids are kept; an empty table gives no rows;
other columns are ignored but for those named in `carry`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.components import components
from tickloom.llm.staging import staged
from tickloom.llm.words import distinct, hashes, mix, shingles, slices, spans, text_bytes
from tickloom.llm.workers import ship

#: A group holds at most so many nodes, and about so many shingles.
GROUP_NODES, GROUP_SHINGLES = 2048, 1 << 21
#: Shingles that may travel in any round.
ROUND_SHINGLES = 1 << 27
#: Bits of the filters that pass documents whose needs and sets must be worked out.
FILTER_BITS = 1 << 23
_NODE, _PART = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


class Schemes:
    """Size classes and the number of parts in each; scheme 2c is class c, 2c + 1 the border above it."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den
        self.lows = [1]
        while self.lows[-1] < 1 << 31:
            self.lows.append(max(self.lows[-1] + 1, -(-self.lows[-1] * max(3 * num, 2 * den) // (2 * num))))
        totals = []
        for c, high in enumerate(self.lows[1:]):
            totals += [2 * (high - 1), (high - 1) + (high - 1) * den // num]
        self.most = np.array([s * (den - num) // (den + num) for s in totals], np.int64)
        self.slack = 2 + (self.most + 1) // 8
        self.parts = self.most + 1 + self.slack
        self.lows = np.array(self.lows, np.int64)

    def of(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A set's class scheme, and its border scheme or -1."""
        c = np.searchsorted(self.lows, sizes, "right") - 1
        high, low = self.lows[np.minimum(c + 1, len(self.lows) - 1)], self.lows[np.maximum(c, 0)]
        up = self.den * sizes >= self.num * high
        down = (self.num * sizes <= self.den * (low - 1)) & (c > 0)
        return 2 * c, np.where(up, 2 * c + 1, np.where(down, 2 * c - 1, -1))

    def both(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All border schemes: a class so narrow that a set is near both its borders has two."""
        c = np.searchsorted(self.lows, sizes, "right") - 1
        up = self.den * sizes >= self.num * self.lows[np.minimum(c + 1, len(self.lows) - 1)]
        down = (self.num * sizes <= self.den * (self.lows[np.maximum(c, 0)] - 1)) & (c > 0)
        return np.where(up, 2 * c + 1, -1), np.where(down, 2 * c - 1, -1)


def part_tokens(values: np.ndarray, at: np.ndarray, scheme: np.ndarray, rule: Schemes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of every set under its scheme (-1: none), their number before each set, and how many any partner shares."""
    parts = np.where(scheme >= 0, rule.parts[scheme], 0)
    base = np.concatenate([[0], np.cumsum(parts)])
    row = np.repeat(np.arange(len(scheme)), np.diff(at))
    used = scheme[row] >= 0
    row, values = row[used], values[used]
    part = (mix(values ^ (scheme[row].astype(np.uint64) * _PART)) % parts[row].astype(np.uint64)).astype(np.int64)
    sums = np.zeros(base[-1], np.uint64)
    np.add.at(sums, base[row] + part, mix(values + _PART))
    filled = np.bincount(base[row] + part, minlength=base[-1]) > 0
    owner = np.repeat(np.arange(len(scheme)), parts)
    number = np.arange(base[-1]) - base[owner]
    tokens = mix(sums ^ mix(scheme[owner].astype(np.uint64) << np.uint64(32) | number.astype(np.uint64)))
    empty = parts - np.bincount(owner[filled], minlength=len(scheme))
    # Agreement in empty parts alone is possible only for sets with more of them than the slack.
    kept = filled | (empty > rule.slack[scheme])[owner]
    need = np.maximum(1, parts - rule.most[scheme] - empty)
    return tokens[kept], np.concatenate([[0], np.cumsum(np.bincount(owner[kept], minlength=len(scheme)))]).astype(np.int64), need


def shingle_sets(part: pa.RecordBatch, column: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    data, at = text_bytes(part.column(column))
    starts, stops, rows = spans(data, at)
    return distinct(*shingles(hashes(data, starts, stops), rows, size, short=True))


def set_nodes(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One 64-bit name per set; empty sets have 0."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(values ^ _NODE), dtype=np.uint64)])
    n = np.diff(at)
    return np.where(n > 0, mix(sums[at[1:]] - sums[at[:-1]] + n.astype(np.uint64) * _NODE), np.uint64(0)).view(np.int64)


def set_tokens(values: np.ndarray, at: np.ndarray, rule: Schemes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens of every set, the set of each, and the least number that any partner shares."""
    n = np.diff(at)
    schemes = [np.where(n > 0, s, -1) for s in (rule.of(n)[0], *rule.both(n))]
    found = [part_tokens(values, at, s, rule) for s in schemes]
    need = np.minimum.reduce([np.where(s >= 0, f[2], 1 << 30) for s, f in zip(schemes, found, strict=True)])
    owner = np.concatenate([np.repeat(np.arange(len(n)), np.diff(f[1])) for f in found])
    order = np.argsort(owner, kind="stable")
    return np.concatenate([f[0] for f in found])[order], owner[order], need


def shared_tokens(docs: DataFrame, rule: Schemes, size: int, text_col: str) -> DataFrame:
    """token, node, owner: the tokens of two nodes or more with all their nodes, and the smallest node of each."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text"):
                values, at = shingle_sets(part, "text", size)
                nodes = set_nodes(values, at)
                tokens, owner, _ = set_tokens(values, at, rule)
                fresh = np.zeros(len(nodes), bool)
                for i, node in enumerate(nodes.tolist()):
                    fresh[i] = node not in given
                    given.add(node)
                kept = fresh[owner]
                yield pa.RecordBatch.from_arrays([pa.array(tokens[kept].view(np.int64)), pa.array(nodes[owner[kept]])], ["token", "node"])

    tokens = docs.select(F.col(text_col).alias("text")).mapInArrow(build, "token long, node long")
    same = Window.partitionBy("token")
    both = tokens.select("token", "node", F.min("node").over(same).alias("owner"), F.max("node").over(same).alias("last"))
    return staged(both.where("owner < last").select("token", "node", "owner").distinct(), "shared")


def bit_filter(values: DataFrame, bits: int) -> np.ndarray:
    """A table of `bits` bits (a multiple of 32,768) from a column `p` of places in it; it comes to the driver as rows of 4 KB."""
    out = np.zeros(bits // 8, np.uint8)
    maps = values.groupBy(F.expr("bitmap_bucket_number(p + 1)").alias("k")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p + 1))").alias("bits"))
    for k, found in maps.collect():  # bits / 8 bytes at most; an iterator would run a job per partition
        out[(k - 1) * 4096 : k * 4096] = np.frombuffer(bytes(found), np.uint8)
    return out


def passes(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    return table[places >> 3] >> (places & 7).astype(np.uint8) & 1 > 0


def document_sets(docs: DataFrame, shared: DataFrame, rule: Schemes, size: int, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    """id, carried columns, n, node (NULL for the empty set), need (0 for most sets that share no token): one row per document."""
    bits = bit_filter(shared.select(F.col("node").bitwiseAND(FILTER_BITS - 1).alias("p")), FILTER_BITS)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, at = shingle_sets(part, "text", size)
                n, nodes = np.diff(at), set_nodes(values, at)
                asked = (n > 0) & passes(bits, nodes & (FILTER_BITS - 1))
                need = np.zeros(len(n), np.int32)
                need[asked] = set_tokens(values[np.repeat(asked, n)], np.concatenate([[0], np.cumsum(n[asked])]), rule)[2]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("id", *carry)), pa.array(n), pa.array(nodes, mask=n == 0), pa.array(need)], ["id", *carry, "n", "node", "need"])

    rows = docs.select(F.col(id_col).alias("id"), *carry, F.col(text_col).alias("text"))
    kept = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in ("id", *carry))
    return rows.mapInArrow(build, f"{kept}, n long, node long, need int")


def candidate_groups(sets: DataFrame, shared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes that share as many tokens as any partner must (node, grp, n), and the groups on both sides of every comparison (job, side, grp)."""
    facts = sets.where("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.first("need").alias("need"))
    owned = shared.select("node", "owner").repartition("node").groupBy("node", "owner").agg(F.count("*").alias("c"))
    # Of the owners of most of a node's tokens, the smallest.
    most = F.max(F.struct("c", F.bitwise_not("owner").alias("other"))).alias("most")
    owned = owned.groupBy("node").agg(F.sum("c").alias("c"), most).join(facts, "node").where("c >= need")
    nodes = staged(owned.select("node", F.bitwise_not("most.other").alias("key"), "n", "need"), "nodes")
    large = nodes.groupBy("key").agg(F.count("*").alias("c"), room_of("n").alias("room")).where("c > room")
    # The few large keys are repeated per salt, so that one key's nodes need not meet in one task.
    large = staged(large.select("key", F.ceil(F.col("c") / F.col("room")).alias("chunks"), F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt")), "large")
    salted = nodes.withColumn("salt", F.pmod("node", F.lit(16)).cast("int")).join(large, ["key", "salt"], "left")
    chunk = F.coalesce(F.pmod(F.xxhash64("node"), F.col("chunks")), F.lit(0))
    nodes = staged(salted.select("node", "n", "need", F.xxhash64("key", chunk).alias("grp")), "groups")
    matrix = staged(shared.join(nodes, "node").groupBy("token", "grp").agg(F.min("need").alias("need")), "matrix")
    one, two = (matrix.select("token", F.col("grp").alias(g), F.col("need").alias(f"n{g}")) for g in ("g1", "g2"))
    across = one.join(two, "token").where("g1 < g2").groupBy("g1", "g2").agg(F.count("*").alias("c"), F.min(F.greatest("ng1", "ng2")).alias("need")).where("c >= need")
    return merged(nodes, staged(across.select("g1", "g2"), "pairs"), room_of("n"))


def room_of(size: str) -> Column:
    return F.greatest(F.lit(2), F.least(F.lit(GROUP_NODES), F.floor(F.lit(GROUP_SHINGLES) / F.max(size))))


def merged(nodes: DataFrame, pairs: DataFrame, room: Column) -> tuple[DataFrame, DataFrame]:
    """Small groups put together with those that pairs connect them to, as far as there is room, and the pairs that are left.

    Two groups of a pair are either in one larger group now or in two that are opened together, so no comparison
    is lost; only the groups of such pairs come to the task of two larger ones. Returns (node, grp, n) and (job, side, grp).
    """
    sizes = nodes.groupBy("grp").agg(F.count("*").alias("c"), room.alias("room"))
    near = components(pairs.toDF("a", "b")).toDF("grp", "head")
    small = staged(sizes.where("2 * c <= room").join(near, "grp", "left").withColumn("head", F.coalesce("head", "grp")), "small")
    heads = staged(small.groupBy("head").agg(F.sum("c").alias("total"), F.min("room").alias("least")), "heads")
    bin_ = F.pmod(F.xxhash64("grp"), F.ceil(F.col("total") / F.col("least")))
    homes = staged(small.join(heads, "head").select("grp", F.xxhash64("head", bin_).alias("home")), "homes")
    place = staged(sizes.join(homes, "grp", "left").select("grp", "c", F.coalesce("home", "grp").alias("home")), "places")
    ends = pairs
    for end in ("g1", "g2"):
        ends = ends.join(place.select(F.col("grp").alias(end), F.col("home").alias(f"h{end}")), end)
    job = F.struct(F.least("hg1", "hg2").alias("one"), F.greatest("hg1", "hg2").alias("two")).alias("job")
    ends = ends.where("hg1 <> hg2").select(job, F.col("hg1"), "g1", "g2")
    first = (F.col("hg1") == F.col("job.one")).cast("int")
    across = ends.select("job", (1 - first).alias("side"), F.col("g1").alias("grp")).union(ends.select("job", first.alias("side"), F.col("g2").alias("grp"))).distinct()
    several = place.groupBy("home").agg(F.sum("c").alias("total")).where("total > 1").select("home")
    within = place.join(several, "home", "left_semi").select(F.struct(F.col("home").alias("one"), F.col("home").alias("two")).alias("job"), F.lit(0).alias("side"), "grp")
    return nodes.select("node", "grp", "n"), staged(across.union(within), "opened")


def needed_sets(docs: DataFrame, sets: DataFrame, nodes: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """node, shingles (`packed`) of all `nodes`, one row each, built from one text or from a few of equal sets.

    A bit filter of fixed size passes all ids that are needed and few others, so most texts are not cut
    into shingles again; the join drops what passed in vain. A task gives out each node once, and of
    those of several tasks one stays, so copies of a set don't travel on however full the filter is.
    """
    chosen = sets.where("n > 0").select("node", "id").join(nodes.select("node"), "node", "left_semi").groupBy("node").agg(F.min("id").alias("id"))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    bits = bit_filter(chosen.where("id is not null").select(place("id").alias("p")), FILTER_BITS)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for batch in batches:
            p = batch.column("p").to_numpy()
            for part in slices(batch.filter(pa.array((p < 0) | passes(bits, np.maximum(p, 0)))), "text"):
                values, at = shingle_sets(part, "text", size)
                names = set_nodes(values, at)
                fresh = {node: i for i, node in enumerate(names.tolist()) if at[i + 1] > at[i] and node not in given}
                given.update(fresh)
                keep = np.array(sorted(fresh.values()), np.int64)
                raw = [packed(values[at[i] : at[i + 1]]) for i in keep]
                yield pa.RecordBatch.from_arrays([pa.array(names[keep]), pa.array(raw, pa.binary())], ["node", "shingles"])

    rows = docs.select(F.when(F.col(id_col).isNull(), -1).otherwise(place(id_col)).alias("p"), F.col(text_col).alias("text"))
    built = rows.mapInArrow(build, "node long, shingles binary")
    return staged(built.join(nodes.select("node"), "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("shingles")), "sets")


def packed(values: np.ndarray) -> bytes:
    """The upper 48 bits of sorted hashes. Two sets of 1,000 shingles agree wrongly in one with a chance of 4 in a billion."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view(np.uint64)[:, 0]


class _Forest:
    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)


def open_groups(left: list[np.ndarray], right: list[np.ndarray], num: int, den: int) -> _Forest:
    """Links between sets of `left` and of `right`, numbered on; with `right` empty, among `left`."""
    forest, among = _Forest(len(left) + len(right)), not right
    if among:
        right = left
    sizes = np.array([len(x) for x in right])
    values = np.concatenate(right)
    order = np.argsort(values, kind="stable")
    owners, values = np.repeat(np.arange(len(right)), sizes)[order], values[order]
    for i, query in enumerate(left):
        first, last = np.searchsorted(values, query, "left"), np.searchsorted(values, query, "right")
        hits = last - first
        if den * int((hits > 0).sum()) < num * len(query):
            continue
        runs = np.repeat(first - (np.cumsum(hits) - hits), hits) + np.arange(hits.sum())
        both = np.bincount(owners[runs], minlength=len(right))
        for j in np.flatnonzero(den * both >= num * (sizes + len(query) - both)).tolist():
            if not among or j != i:
                forest.join(i, j if among else len(left) + j)
    return forest


def links(groups: DataFrame, sides: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """a, b: per task a spanning forest of the links between two groups.

    A set travels to every job of its group. Jobs are opened in rounds, so that what travels at once is no more than about
    twice all sets (or ROUND_SHINGLES), however many jobs a family has.
    """

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(held: dict[tuple[int, int], bytes]) -> list[tuple[int, int]]:
            job = sorted((*name, raw) for name, raw in held.items())  # by side, then node
            sides = [[unpacked(raw) for side, _, raw in job if side == s] for s in (0, 1)]
            if len(job) < 2 or not sides[0]:
                return []
            forest = open_groups(*sides, num, den)
            return [(job[i][1], job[r][1]) for i in range(len(job)) if (r := forest.find(i)) != i]

        job, name, edges = {}, None, []  # of a job, each node once
        for batch in batches:
            for key, side, node, raw in zip(*(batch.column(c).to_pylist() for c in ("job", "side", "node", "shingles")), strict=True):
                if key != name:
                    edges += close(job)
                    job, name = {}, key
                job.setdefault((side, node), raw)
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*edges, strict=True)], ["a", "b"])
                edges = []
        if edges := close(job):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*edges, strict=True)], ["a", "b"])

    members = groups.groupBy("grp").agg(F.sum("n").alias("n"))
    held, travel = (x.agg(F.sum("n")).first()[0] or 0 for x in (members, sides.join(members, "grp")))
    rounds, found = max(1, math.ceil(travel / max(2 * held, ROUND_SHINGLES))), []
    for k in range(rounds):
        own = sides.where(F.pmod(F.xxhash64("job"), F.lit(rounds)) == k)
        rows = own.join(groups.select("node", "grp"), "grp").join(sets, "node").select("job", "side", "node", "shingles")
        found.append(staged(rows.repartition("job").sortWithinPartitions("job").mapInArrow(verify, "a long, b long"), "links"))
    return found[0] if rounds == 1 else staged(reduce(DataFrame.union, found), "links")


def jaccard_components(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """id, carried columns, n_shingles, node, label (one for each group), component (smallest id reachable by links) for every row."""
    rule, carry = Schemes(num, den), list(carry)
    ship(docs.sparkSession)
    shared = shared_tokens(docs, rule, size, text_col)
    sets = staged(document_sets(docs, shared, rule, size, id_col, text_col, carry), "documents")
    groups, sides = candidate_groups(sets, shared)
    shingled = needed_sets(docs, sets, groups, size, id_col, text_col)
    labels = components(links(groups, sides, shingled, num, den))
    firsts = sets.where("node is not null").groupBy("node").agg(F.min("id").alias("first"))
    named = staged(firsts.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "named")
    least = staged(named.groupBy("label").agg(F.min("first").alias("component")), "least")
    found = staged(named.join(least, "label").select("node", "label", "component"), "components")
    out = sets.select("id", *carry, F.col("n").alias("n_shingles"), "node").join(found, "node", "left")
    return out.withColumn("component", F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component")))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id over three-word shingles at a similarity of 0.9."""
    found = jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=3, num=90, den=100)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))
