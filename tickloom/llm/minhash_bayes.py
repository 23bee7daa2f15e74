"""Near duplicates by MinHash bands, sequential Bayesian verification and an exact check of what survives.

Documents with one and the same shingle set are one node from the start. For the nodes:

1. Signatures. A node has `bands` x `rows` minima, and a bucket per band. A pair at the similarity asked for
   shares no bucket with a chance below `miss`; the number of bands follows from that.
2. Leaders. The smallest node of a bucket is its leader; every other node of the bucket is paired with it. So a bucket
   gives as many pairs as it has nodes, however large a group of similar documents is.
3. Verification. Signatures of a pair (one byte per minimum) are compared batch by batch. With m of k equal and
   a uniform prior, the similarity's posterior is a beta distribution; a pair goes as soon as the posterior
   chance of reaching the similarity asked for falls below `miss`.
4. Exact check on full sets: for every node first its likeliest pair, then the other survivors whose nodes are not
   connected yet. A pair inside a component can't change the result.
5. Crossing. What leaders can't see are links between two other nodes of a bucket. Buckets whose other nodes
   are still of several components are opened: each node outside the bucket's most frequent component meets all
   nodes of other components there, in blocks of BLOCK x BLOCK, by step 3. Of the likely pairs of a block, those that
   join its components to a tree are checked on full sets.
6. Zones. Components that are still apart but joined by likely pairs make a zone; every likely pair of unlike
   components is inside one. A zone's blocks are opened with their full sets: each node outside the zone's largest
   component meets all others, likely pairs are checked exactly at once, and a task returns a tree of links. So a
   group of n near copies gives some n rows, whatever its likely pairs, and each of its sets travels to as
   many tasks as there are blocks on the other side. Nothing is capped.
7. Components of all links.

A link is lost only where a bucket or a posterior misses it, each with a chance below `miss` (1e-8 and 1e-7 per
batch), and where no other path of links joins the two documents either. Every link that is used was confirmed on
full sets (hashes of 64 bits, 48 in the exact check).

Cases: NULL texts, empty ones and those without words have no shingles and are linked with nothing; a shorter
text than a shingle has its whole word sequence as one; rows that repeat an id keep their own texts, and the
component's id is the smallest one of its rows, NULL only if none has an id; repeated rows are each returned;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.components import components, onward, roots
from tickloom.llm.jaccard_groups import needed_sets, set_nodes, shingle_sets, unpacked
from tickloom.llm.staging import staged
from tickloom.llm.words import mix, nested, slices
from tickloom.llm.workers import ship

ROWS = 5
BUCKET_MISS, POSTERIOR_MISS = 1e-8, 1e-7
#: Minima compared at once.
BATCH = 32
BLOCK = 1024
#: Pairs whose signatures are in memory at once.
PAIRS = 1 << 17
#: Shingles of a block whose sets are opened.
BLOCK_SHINGLES = 1 << 19
_SEED = np.uint64(0xD1B54A32D192ED03)


def bands_for(similarity: float, rows: int = ROWS, miss: float = BUCKET_MISS) -> int:
    """Bands that a pair of that similarity shares none of with a chance below `miss`."""
    return math.ceil(math.log(miss) / math.log1p(-(similarity**rows))) if similarity < 1 else 1


def signatures(values: np.ndarray, at: np.ndarray, hashes: int) -> np.ndarray:
    """Least value of every hash function over each set (sets x hashes); all sets have a value at least."""
    out = np.empty((len(at) - 1, hashes), np.uint32)
    seeds = mix(np.arange(1, 2 * hashes + 1, dtype=np.uint64) * _SEED)
    scrambled = np.empty_like(values)
    for k in range(hashes if len(out) else 0):
        np.bitwise_xor(values, seeds[2 * k], out=scrambled)
        np.multiply(scrambled, seeds[2 * k + 1] | np.uint64(1), out=scrambled)
        out[:, k] = np.minimum.reduceat(scrambled, at[:-1]) >> np.uint64(32)
    return out


def buckets(minima: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit bucket per band."""
    bands = minima.shape[1] // rows
    out = mix(np.arange(1, bands + 1, dtype=np.uint64) * _SEED)[None, :].repeat(len(minima), 0)
    for r in range(rows):
        out = mix(out ^ minima[:, r::rows][:, :bands].astype(np.uint64) * _SEED)
    return out


def least_matches(similarity: float, hashes: int, miss: float = POSTERIOR_MISS) -> list[tuple[int, int]]:
    """After how many compared minima (by batches), how many equal ones a pair must have at least to go on.

    One byte of two unequal minima agrees once in 256. The posterior of the chance p of agreement is
    Beta(m + 1, k - m + 1); that it reaches p0 has the chance that a binomial of k + 1 trials at p0 is m at most.
    """
    p0 = similarity + (1 - similarity) / 256
    out = []
    for k in [*range(BATCH, hashes, BATCH), hashes]:
        chance, m = 0.0, -1
        while chance < miss and m <= k:
            m += 1
            chance += math.comb(k + 1, m) * p0**m * (1 - p0) ** (k + 1 - m)
        out.append((k, m))
    return out


def surviving(one: np.ndarray, two: np.ndarray, rule: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of signatures that no batch has ruled out, and their equal minima."""
    left, equal, before = np.arange(len(one)), np.zeros(len(one), np.int64), 0
    for k, least in rule:
        equal = equal + (one[left, before:k] == two[left, before:k]).sum(1)
        kept = equal >= least
        left, equal, before = left[kept], equal[kept], k
    return left, equal


def signed(docs: DataFrame, size: int, rows: int, hashes: int, id_col: str, text_col: str) -> DataFrame:
    """id, n, node (NULL for the empty set) of every document; with signature and buckets once per node and task."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text"):
                values, at = shingle_sets(part, "text", size)
                n = np.diff(at)
                nodes = set_nodes(values, at)
                fresh = {node: i for i, node in enumerate(nodes.tolist()) if n[i] and node not in given}
                given.update(fresh)
                new = np.array(sorted(fresh.values()), np.int64)
                kept = np.zeros(len(n), bool)
                kept[new] = True
                minima = signatures(values[np.repeat(kept, n)], np.concatenate([[0], np.cumsum(n[new])]), hashes)
                back = np.full(len(n), -1)
                back[new] = np.arange(len(new))
                back = pa.array(back, mask=back < 0)
                found = buckets(minima, rows)
                raw = pa.array([x.tobytes() for x in minima.astype(np.uint8)], pa.binary())
                lists = nested(found.ravel(), np.arange(len(new) + 1) * found.shape[1], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n), pa.array(nodes, mask=n == 0), raw.take(back), lists.take(back)], ["id", "n", "node", "sig", "buckets"]
                )

    rows_ = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows_.mapInArrow(build, "id long, n long, node long, sig binary, buckets array<long>")


def _matrix(column: pa.Array, hashes: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, hashes)


def likely(pairs: DataFrame, nodes: DataFrame, hashes: int, rule: list[tuple[int, int]]) -> DataFrame:
    """a, b, m (equal minima) of the pairs that survive."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, equal = surviving(_matrix(batch.column("one"), hashes), _matrix(batch.column("two"), hashes), rule)
            at = pa.array(left)
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at), pa.array(equal)], ["a", "b", "m"])

    one, two = (nodes.select(F.col("node").alias(k), F.col("sig").alias(c)) for k, c in (("a", "one"), ("b", "two")))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two").mapInArrow(compare, "a long, b long, m long")


def confirmed(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that link, by their full sets."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i, (x, y) in enumerate(zip(batch.column("one").to_pylist(), batch.column("two").to_pylist(), strict=True)):
                x, y = unpacked(x), unpacked(y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if den * both >= num * (len(x) + len(y) - both):
                    kept.append(i)
            at = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], ["a", "b"])

    one, two = (sets.select(F.col("node").alias(k), F.col("shingles").alias(c)) for k, c in (("a", "one"), ("b", "two")))
    return staged(pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two").mapInArrow(check, "a long, b long"), "links")


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose nodes are of different components, with these (la, lb)."""
    for end in ("a", "b"):
        pairs = pairs.join(labels.select(F.col("node").alias(end), F.col("label").alias(f"l{end}")), end, "left")
        pairs = pairs.withColumn(f"l{end}", F.coalesce(f"l{end}", end))
    return pairs.where("la <> lb")


def linked(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after `links` (a, b), by the components of a graph whose nodes are the labels before."""
    ends = apart(links, labels).select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct()
    return staged(onward(labels, components(staged(ends, "label-links"))), "labels")


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Rows sorted by `key`, put together so that no value is in two batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy()
        ahead = np.flatnonzero(values != values[-1])
        cut = int(ahead[-1]) + 1 if len(ahead) else 0
        if cut or (held and held[-1].column(key)[-1].as_py() != values[-1]):
            held.append(batch.slice(0, cut))
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def blocks_of(members: DataFrame, unit: str, weight: str) -> DataFrame | None:
    """job, side, node, label, other: what meets what where a `unit` holds several labels. None: nowhere.

    A node outside its unit's most frequent label (side 0) meets all blocks of the unit, in the job of its own
    block; every node (side 1) is met by all of those. `weight` is a node's share of a block.
    """
    sizes = staged(members.groupBy(unit, "label").agg(F.count("*").alias("c"), F.sum(weight).alias("w")), "sizes")
    several = sizes.groupBy(unit).agg(F.max_by("label", "c").alias("main"), F.max("c").alias("c"), F.sum("c").alias("total"), F.sum("w").alias("w"))
    several = several.where("c < total").withColumn("each", F.col("w") / F.col("total"))
    blocks = lambda n: F.ceil(F.greatest(F.expr(n) / BLOCK, F.expr(n) * F.col("each"))).cast("int")
    several = staged(several.select(unit, "main", blocks("total - c").alias("others"), blocks("total").alias("all")), "opened")
    if several.isEmpty():
        return None
    rows = staged(members.join(several, unit), "members")
    other = F.col("label") != F.col("main")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1))
    part = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("long")
    asks = rows.where(other).select(unit, part("others").alias("i"), each("all").alias("j"), F.lit(0).alias("side"), "node", "label", F.lit(True).alias("other"))
    meets = rows.select(unit, each("others").alias("i"), part("all").alias("j"), F.lit(1).alias("side"), "node", "label", other.alias("other"))
    return staged(asks.union(meets).select(F.xxhash64(unit, "i", "j").alias("job"), "side", "node", "label", "other"), "jobs")


class _Labels:
    """Labels joined in a task."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> bool:
        """Whether they were apart."""
        x, y = self.find(x), self.find(y)
        self.up[x] = y
        return x != y


def likely_pairs(t: pa.RecordBatch, hashes: int, rule: list[tuple[int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows x, y of whole jobs that are likely and of unlike labels, and their equal minima; by some PAIRS at once."""
    job, side, node, label = (t.column(c).to_numpy() for c in ("job", "side", "node", "label"))
    other, sig = t.column("other").to_numpy(zero_copy_only=False), _matrix(t.column("sig"), hashes)
    new = np.append(True, job[1:] != job[:-1])
    starts = np.flatnonzero(new)
    asking, meeting = np.add.reduceat(1 - side, starts), np.add.reduceat(side, starts)
    ask = np.flatnonzero(side == 0)  # of a job, the asking rows come first
    of = (np.cumsum(new) - 1)[ask]
    first, width = (starts + asking)[of], meeting[of]
    stop, k = np.cumsum(width), 0
    while k < len(ask):
        last = max(k + 1, int(np.searchsorted(stop, (stop[k - 1] if k else 0) + PAIRS, "right")))
        each = width[k:last]
        x = np.repeat(ask[k:last], each)
        y = np.repeat(first[k:last] - np.cumsum(each) + each, each) + np.arange(each.sum())
        # Two nodes outside the main component meet twice.
        kept = (label[x] != label[y]) & ~(other[y] & (node[y] < node[x]))
        x, y = x[kept], y[kept]
        left, equal = surviving(sig[x], sig[y], rule)
        yield x[left], y[left], equal
        k = last


def crossing(entries: DataFrame, labels: DataFrame, nodes: DataFrame, hashes: int, rule: list[tuple[int, int]]) -> DataFrame | None:
    """a, b: likely pairs that join the components of a bucket's block to a tree. None: no bucket to open."""
    named = entries.join(labels, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("label"), F.lit(0.0).alias("w"))
    jobs = blocks_of(staged(named, "named"), "bucket", "w")
    if jobs is None:
        return None

    def open_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "job"):
            job, node, label = (t.column(c).to_numpy() for c in ("job", "node", "label"))
            best: dict[tuple[int, int, int], tuple[int, int, int]] = {}
            for x, y, m in likely_pairs(t, hashes, rule):
                one, two = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
                order = np.lexsort((-m, two, one, job[x]))
                run = np.column_stack([job[x], one, two])[order]
                top = order[np.append(True, (run[1:] != run[:-1]).any(1))[: len(run)]]
                for key, found in zip(zip(job[x][top].tolist(), one[top].tolist(), two[top].tolist()), zip(m[top].tolist(), node[x][top].tolist(), node[y][top].tolist())):
                    if best.get(key, (-1,)) < found:
                        best[key] = found
            trees: dict[int, _Labels] = {}
            kept = []
            for (j, one, two), (_, a, b) in sorted(best.items(), key=lambda item: -item[1][0]):
                if trees.setdefault(j, _Labels()).join(one, two):
                    kept.append((min(a, b), max(a, b)))
            a, b = zip(*kept) if kept else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    full = jobs.join(nodes.select("node", "sig"), "node").repartition("job").sortWithinPartitions("job", "side")
    return full.select("job", "side", "node", "label", "other", "sig").mapInArrow(open_blocks, "a long, b long").distinct()


def settled(members: DataFrame, nodes: DataFrame, sets: DataFrame, hashes: int, rule: list[tuple[int, int]], num: int, den: int) -> DataFrame | None:
    """a, b: links, a tree per block, between the components of every zone. members: zone, node, label, w. None: no zone."""
    jobs = blocks_of(members, "zone", "w")
    if jobs is None:
        return None

    def open_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "job"):
            job, side, node, label = (t.column(c).to_numpy() for c in ("job", "side", "node", "label"))
            raw = t.column("shingles").to_pylist()
            trees: dict[int, _Labels] = {}
            index: tuple = (None,)  # of one job: its right side's shingles, sorted, and their owners
            kept = []
            for x, y, _ in likely_pairs(t, hashes, rule):
                edges = np.flatnonzero(np.append(True, x[1:] != x[:-1])[: len(x)])
                for k, stop in zip(edges.tolist(), [*edges[1:].tolist(), len(x)]):
                    i, j = int(x[k]), int(job[x[k]])
                    tree = trees.setdefault(j, _Labels())
                    mine = int(label[i])
                    open_ = [int(r) for r in y[k:stop] if tree.find(int(label[r])) != tree.find(mine)]
                    if not open_:
                        continue
                    if index[0] != j:
                        right = np.flatnonzero((job == j) & (side == 1))
                        lists = [unpacked(raw[r]) for r in right]
                        values = np.concatenate(lists)
                        order = np.argsort(values, kind="stable")
                        sizes = np.array([len(v) for v in lists])
                        index = (j, int(right[0]), values[order], np.repeat(np.arange(len(right)), sizes)[order], sizes)
                    _, base, values, owners, sizes = index
                    asked = unpacked(raw[i])
                    low, high = np.searchsorted(values, asked, "left"), np.searchsorted(values, asked, "right")
                    hits = high - low
                    both = np.bincount(owners[np.repeat(low - np.cumsum(hits) + hits, hits) + np.arange(hits.sum())], minlength=len(sizes))
                    for r in open_:
                        n = both[r - base]
                        if den * n >= num * (len(asked) + sizes[r - base] - n) and tree.join(mine, int(label[r])):
                            kept.append((int(node[i]), int(node[r])))
            a, b = zip(*kept) if kept else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    full = jobs.join(nodes.select("node", "sig"), "node").join(sets, "node").repartition("job").sortWithinPartitions("job", "side")
    return staged(full.select("job", "side", "node", "label", "other", "sig", "shingles").mapInArrow(open_blocks, "a long, b long"), "links")


def zones(known: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """zone, node, label, w: all nodes of the zones (`known`: node, zone) that still hold several labels; w is a node's share of BLOCK_SHINGLES."""
    named = known.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    several = named.groupBy("zone").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least < most").select("zone")
    sizes = sets.where("node is not null").groupBy("node").agg((F.first("n") / BLOCK_SHINGLES).alias("w"))
    return staged(sizes.join(named.join(several, "zone"), "node").select("zone", "node", "label", "w"), "zones")


def near_components(
    docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, n_shingles, node, label (one for each group), component (smallest id reachable by links) for every row."""
    ship(docs.sparkSession)
    bands = bands_for(num / den, rows)
    hashes = bands * rows
    rule = least_matches(num / den, hashes)

    def shingled(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        return needed_sets(docs, sets, staged(ends, "ends"), size, id_col, text_col)

    sets = staged(signed(docs, size, rows, hashes, id_col, text_col), "signed")
    nodes = staged(sets.where("sig is not null").select("node", "sig", "buckets").dropDuplicates(["node"]), "nodes")
    entries = nodes.select("node", F.explode("buckets").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader < last")
    shared = staged(shared.select("bucket", "leader"), "leaders")
    others = staged(entries.join(shared, "bucket").where("node <> leader"), "entries")
    pairs = staged(others.select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    found = staged(likely(pairs, nodes, hashes, rule), "likely")

    best = staged(found.groupBy("b").agg(F.max_by("a", "m").alias("a")).select("a", "b"), "best")
    texts = shingled(found)
    labels = roots(confirmed(best, texts, num, den))  # a leader is less than its node: a forest
    rest = staged(apart(found.select("a", "b").join(best, ["a", "b"], "left_anti"), labels).select("a", "b"), "rest")
    labels = linked(labels, confirmed(rest, texts, num, den))
    across = crossing(others.select("bucket", "node"), labels, nodes, hashes, rule)
    if across is not None and not (across := staged(across, "crossing")).isEmpty():
        # Two graphs of labels in the same rounds: of the links, and of all likely pairs, whose components are the zones.
        across = staged(apart(across, labels), "across")
        ends = lambda x, graph: x.select(F.lit(graph).alias("graph"), F.col("la").alias("a"), F.col("lb").alias("b"))
        links = confirmed(across.select("a", "b"), shingled(across), num, den)
        both = components(staged(ends(across.join(links, ["a", "b"]), 0).union(ends(across, 1)).distinct(), "graphs"), by=("graph",))
        of = lambda graph: both.where(F.col("graph") == graph).select("node", "label")
        known = onward(labels, of(1), "inner").toDF("node", "zone")
        labels = staged(onward(labels, of(0)), "labels")
        members = zones(known, labels, sets)
        more = settled(members, nodes, needed_sets(docs, sets, members, size, id_col, text_col), hashes, rule, num, den)
        if more is not None and not more.isEmpty():
            labels = linked(labels, more)
    firsts = sets.where("node is not null").groupBy("node").agg(F.min("id").alias("first"))
    named = staged(firsts.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "named")
    least = staged(named.groupBy("label").agg(F.min("first").alias("component")), "least")
    known = staged(named.join(least, "label").select("node", "label", "component"), "components")
    out = sets.select("id", F.col("n").alias("n_shingles"), "node").join(known, "node", "left")
    return out.withColumn("component", F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component")))


def op12_minhash_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept over two-word shingles at a similarity of 0.8."""
    found = near_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=2, num=80, den=100)
    ids = found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))
    return ids.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
