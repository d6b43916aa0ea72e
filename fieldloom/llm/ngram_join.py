"""N-gram Jaccard join by prefix trees, and the components of its links.

A document is the set of its word shingles.  Sets that share too little with all others go first: a
set with more unique shingles than the threshold leaves room for cannot have a partner.  The rest
meet in buckets: of any two linked sets, the rarest-first prefixes share a shingle, and a shingle's
bucket is named by the smallest set that holds it, so near copies meet in one or two buckets.
Inside a bucket the sets are a trie in one global order; all sets walk it, carrying their partial
overlaps from node to node, and never enter a subtree that their remaining length cannot lift to
the threshold.  Buckets above ``BUCKET`` sets or ``SHINGLES`` shingles are cut by size band and into
chunks that all hold the bucket's leader; sets that their chunk does not tie to the leader then walk
the tries of the bucket's chunks in their own and the neighbouring bands, as only those can link.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fresh, give_back, lower_ascii, mix, row_key, skew_safe_join, span_hashes, text_slices, words

SHINGLE = 5
#: Links when PERCENT[0] * intersection >= PERCENT[1] * union.
PERCENT = (100, 80)
#: Sets, and shingles, in a trie.
BUCKET = 512
SHINGLES = 1 << 19
#: Share of all shingle hashes that the first stage looks at; the others could only prove more sets single.
REGION = 0.30
BROADCAST_ROWS = 500_000
#: Text bytes that a task turns into sets at once, or one text.
SLICE = 1 << 20


def need(total: np.ndarray | int) -> np.ndarray | int:
    """Least intersection that links two sets with ``total`` elements together."""
    a, b = PERCENT
    return -(-b * total // (a + b))


def prefix_length(n: int) -> int:
    """A set of n shares more than n - prefix_length(n) elements with any partner."""
    a, b = PERCENT
    return n - -(-b * n // a) + 1


@np.errstate(over="ignore")
def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the distinct k-word shingles of each document.

    With fewer words the whole sequence is the only shingle; without words the set is empty.
    """
    low = lower_ascii(data)
    starts, ends, doc = words(low, offsets)
    documents = len(offsets) - 1
    if not len(starts):
        return [np.zeros(0, np.uint64)] * documents
    hashes = span_hashes(low, starts, ends)
    count = np.bincount(doc, minlength=documents)
    first = np.concatenate([[0], np.cumsum(count)])
    whole = np.zeros(len(hashes) + k, np.uint64)
    whole[: len(hashes)] = hashes
    rolled = np.zeros(len(hashes), np.uint64)
    for i in range(k):
        rolled = mix(rolled * np.uint64(0x9E3779B97F4A7C15) + whole[i : i + len(hashes)] + np.uint64(i))
    out = []
    for d in range(documents):
        a, b = int(first[d]), int(first[d + 1])
        if b - a >= k:
            out.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            x = np.uint64(b - a)
            for h in hashes[a:b]:
                x = mix(np.array([x * np.uint64(3) + h], np.uint64))[0]
            out.append(np.array([x], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _set_rows(docs: DataFrame, id_col: str, text_col: str, share: float) -> DataFrame:
    """(__id, __k, n, node, mark, tokens): the set's size and 128-bit hash, and its shingles in that share of all hashes.

    ``mark`` is half of the hash as a number.  ``__k`` is a hash of the row.
    """
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    top = np.uint64(min(int(share * (1 << 64)), (1 << 64) - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch, data, offsets in text_slices(batches, "__text", SLICE):
                sets = shingle_sets(data, offsets)
                sizes = pa.array([len(s) for s in sets], pa.int64())
                nodes = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                marks = pa.array([int.from_bytes(x[:8], "little", signed=True) for x in nodes], pa.int64())
                if share < 1:
                    sets = [s[: np.searchsorted(s, top)] for s in sets]
                cut = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)))
                del sets
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sizes, pa.array(nodes, pa.binary()), marks, tokens], ["__id", "__k", "n", "node", "mark", "tokens"])
        give_back()

    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    rows = rows.select("__id", _row_hash("__id", "__text").alias("__k"), "__text")
    return rows.mapInArrow(run, f"__id {kind}, __k long, n long, node binary, mark long, tokens array<long>")


def _row_hash(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string"))


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every run, in one array."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


class Trie:
    """A compressed prefix tree over sets of ranks; frequent elements rank first, so copies share paths.

    Sets outside ``inside`` get ranks, so that they can walk, but no place in the tree.
    """

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, inside: np.ndarray | None = None):
        self.sizes = np.asarray(sizes, np.int64)
        self.inside = np.ones(len(sets), bool) if inside is None else inside
        flat = np.concatenate([*sets, np.zeros(0, np.int64)])
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        values, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
        shared = count > 1  # an element of one set only adds to its size
        order = np.lexsort((values, -count))
        rank = np.empty(len(values), np.int64)
        rank[order] = np.arange(len(values))
        keep = shared[inverse]
        ranks, owner = rank[inverse[keep]], owner[keep]
        by = np.lexsort((ranks, owner))
        self.ranks = np.split(ranks[by], np.searchsorted(owner[by], np.arange(1, len(sets)))) if len(sets) else []
        self.universe = int(shared.sum())
        #: Nodes that walks have entered so far, one for each walker.
        self.visited = 0
        self._build()

    def _build(self) -> None:
        """Sets in lexicographic order; a stack of open nodes, cut where neighbours part."""
        order = sorted(np.flatnonzero(self.inside).tolist(), key=lambda i: self.ranks[i].tolist())
        parent, segments, depth, ends = [-1], [np.zeros(0, np.int64)], [0], [[]]
        stack, last = [0], np.zeros(0, np.int64)
        for i in order:
            own = self.ranks[i]
            m = min(len(own), len(last))
            differ = np.flatnonzero(own[:m] != last[:m])
            common = int(differ[0]) if len(differ) else m
            child = None
            while depth[stack[-1]] > common:
                child = stack.pop()
            top = stack[-1]
            if depth[top] < common:  # split the edge to child
                middle = len(parent)
                take = common - depth[top]
                parent.append(top)
                segments.append(segments[child][:take])
                depth.append(common)
                ends.append([])
                parent[child], segments[child] = middle, segments[child][take:]
                stack.append(middle)
                top = middle
            if len(own) > common:
                parent.append(top)
                segments.append(own[common:])
                depth.append(len(own))
                ends.append([])
                stack.append(len(parent) - 1)
            ends[stack[-1]].append(i)
            last = own
        self.parent, self.depth, n = np.array(parent), np.array(depth), len(parent)
        size = np.array([len(s) for s in segments])
        self.flat = np.concatenate(segments)
        self.start = np.concatenate([[0], np.cumsum(size)])
        self.last_rank = np.array([s[-1] if len(s) else -1 for s in segments])
        #: In each subtree: the smallest set, and the most elements below a node.
        self.smallest, self.deepest = np.full(n, 1 << 60), np.array(depth)
        for v, own in enumerate(ends):
            if own:
                self.smallest[v] = self.sizes[own].min()
        for v in np.argsort(depth, kind="stable")[:0:-1]:  # a parent is less deep than its children
            p = self.parent[v]
            self.smallest[p] = min(self.smallest[p], self.smallest[v])
            self.deepest[p] = max(self.deepest[p], self.deepest[v])
        self.kids = np.argsort(self.parent, kind="stable")[1:]  # the root, with parent -1, comes first
        self.kid_count = np.bincount(self.parent[1:], minlength=n)
        self.kid_start = np.cumsum(self.kid_count) - self.kid_count
        self.end_count = np.array([len(e) for e in ends])
        self.end_start = np.cumsum(self.end_count) - self.end_count
        self.end_set = np.array([i for e in ends for i in e], np.int64)

    def partners(self, walkers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(walker, set): all other sets in the tree that link with each walker, and maybe itself."""
        block = max(1, min((1 << 24) // (self.universe + 1), (1 << 20) // max(1, len(self.flat))))
        found = [self._walk(walkers[i : i + block]) for i in range(0, len(walkers), block)]
        return tuple(np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2

    def _walk(self, walkers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All walkers go down together, a level at a time; (walker, node, overlap) is a row of the front."""
        wide = self.universe + 1
        own = [self.ranks[i] for i in walkers.tolist()]
        held = np.array([len(r) for r in own])
        last = np.cumsum(held)
        keys = np.concatenate([k * wide + r for k, r in enumerate(own)])
        member = np.zeros(len(walkers) * wide, bool)
        member[keys] = True
        sizes = self.sizes[walkers]
        w, v, overlap = np.arange(len(walkers)), np.zeros(len(walkers), np.int64), np.zeros(len(walkers), np.int64)
        out_w, out_s = [], []
        while len(w):
            n = self.end_count[v]
            if n.any():
                who, both = np.repeat(w, n), np.repeat(overlap, n)
                which = self.end_set[_ragged(self.end_start[v], n)]
                link = both >= need(sizes[who] + self.sizes[which])
                out_w.append(walkers[who[link]])
                out_s.append(which[link])
            n = self.kid_count[v]
            w, overlap = np.repeat(w, n), np.repeat(overlap, n)
            v = self.kids[_ragged(self.kid_start[v], n)]
            w, v, overlap = self._prune(w, v, overlap, self.flat[self.start[v]], self.depth[self.parent[v]], keys, last, sizes)
            if not len(w):
                break
            self.visited += len(w)
            n = self.start[v + 1] - self.start[v]
            hit = member[np.repeat(w * wide, n) + self.flat[_ragged(self.start[v], n)]]
            overlap = overlap + np.add.reduceat(hit, np.cumsum(n) - n, dtype=np.int64)
            w, v, overlap = self._prune(w, v, overlap, self.last_rank[v] + 1, self.depth[v], keys, last, sizes)
        return np.concatenate([np.zeros(0, np.int64), *out_w]), np.concatenate([np.zeros(0, np.int64), *out_s])

    def _prune(self, w: np.ndarray, v: np.ndarray, overlap: np.ndarray, rank: np.ndarray, depth: np.ndarray, keys: np.ndarray, last: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Rows that can still reach the threshold: from ``rank`` and ``depth`` on, walker and subtree have so much left."""
        left = last[w] - np.searchsorted(keys, w * (self.universe + 1) + rank)
        room = np.minimum(left, self.deepest[v] - depth)
        on = overlap + room >= need(sizes[w] + self.smallest[v])
        return w[on], v[on], overlap[on]


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number that each of 0..n-1 reaches by the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for end in (a, b, root[a], root[b]):
            np.minimum.at(new, end, low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            return root
        root = new


def bucket_links(sets: list[np.ndarray], sizes: np.ndarray, probes: np.ndarray) -> np.ndarray:
    """The root of every member of one bucket, by all its links.

    ``probes`` marks sets that only walk the trie of the others; without any, every set walks.
    """
    trie = Trie(sets, sizes, ~probes)
    walkers = np.flatnonzero(probes) if probes.any() else np.arange(len(sets))
    return roots(len(sets), *trie.partners(walkers))


_LINKS = "bucket long, band int, a long, b long, loose boolean"


def _walk(groups: DataFrame, by: list[str]) -> DataFrame:
    """Run every group's trie: links (a, b), and rows (a = member, loose) not tied to the leader."""
    width = len(by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            columns = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(width)], 1)
            cut = [0, *(np.flatnonzero((columns[1:] != columns[:-1]).any(1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if a == b:
                    continue
                own = tuple(columns[a].tolist())
                if key is not None and own != key:
                    yield from _run_group(key, held)
                    held = []
                key = own
                held.append(batch.slice(a, b - a))
        if held:
            yield from _run_group(key, held)
        give_back()

    return groups.select(*by, "sid", "n", "tokens", "probe", "large").repartition(*by).sortWithinPartitions(*by, "sid", "probe").mapInArrow(run, _LINKS)


def _run_group(key: tuple, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(held)
    if table.num_rows < 2:
        return
    ids, sizes = table["sid"].to_numpy(), table["n"].to_numpy()
    probes = table["probe"].to_numpy().astype(bool)
    sets = [np.asarray(x.values) for c in table["tokens"].chunks for x in c]
    root = bucket_links(sets, sizes, probes)
    tied = np.flatnonzero(root != np.arange(len(ids)))
    loose = np.zeros(0, np.int64)
    if table["large"][0].as_py() and not probes.any():
        loose = np.flatnonzero(root != root[int(np.flatnonzero(ids == key[0])[0])])
    n, m = len(tied), len(loose)
    if n + m:
        none = np.zeros(m, np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n + m, key[0], np.int64)), pa.array(np.full(n + m, key[1], np.int32)), pa.array(np.concatenate([ids[tied], ids[loose]])),
                pa.array(np.concatenate([ids[root[tied]], none]), mask=np.arange(n + m) >= n), pa.array(np.arange(n + m) >= n),
            ],
            ["bucket", "band", "a", "b", "loose"],
        )


def _within(df: DataFrame) -> DataFrame:
    """Broadcast a written table if its counted rows allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root): the smallest node that each node of ``links`` (a, b) reaches.

    Alternates two steps until nothing changes: every node hands its smallest neighbour to its larger
    neighbours, then to its smaller ones.  Each round is written down; hubs are joined skew-safe.
    """
    sign = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    edges = scratch.write(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links-0")
    before, k = sign(edges), 0
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("__m"), F.count("*").alias("__d"))
        large = skew_safe_join(both, least, ["a"], "__d", 2 * before[0]).where("b > a").select(F.col("b").alias("a"), F.col("__m").alias("b")).where("a <> b").distinct()
        large = scratch.write(large, f"large-{k}")
        least = large.groupBy("a").agg(F.min("b").alias("__m"), F.count("*").alias("__d"))
        small = skew_safe_join(large, least, ["a"], "__d", large.count())
        small = small.select(F.when(F.col("b") == F.col("__m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("__m").alias("b")).where("a <> b").distinct()
        edges = scratch.write(small, f"links-{k + 1}")
        scratch.drop(f"large-{k}", f"links-{k}")
        before, last, k = sign(edges), before, k + 1
        if before == last:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _size_band(n: Column) -> Column:
    """Linked sets are in the same or in neighbouring bands."""
    a, b = PERCENT
    return F.floor(F.log(n.cast("double")) / math.log(a / b) + 1e-9).cast("int")


def set_links(full: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (a, b) that connect the sets (sid, n, tokens) as all links above the threshold would."""
    total = int(full.agg(F.sum("n")).first()[0] or 0)
    tokens = full.select("sid", "n", F.explode("tokens").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("__df"), F.min("sid").alias("__leader")).where("__df > 1")
    shared = scratch.write(shared, "shared")
    known = skew_safe_join(tokens, shared, ["token"], "__df", total)
    listed = known.groupBy("sid").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("__df", "token", "__leader"))).alias("__list"))
    a, b = PERCENT
    length = F.col("n") - F.ceil(F.col("n") * b / a) + 1
    room = F.greatest(length - (F.col("n") - F.size("__list")), F.lit(0)).cast("int")
    leaders = F.array_distinct(F.transform(F.slice("__list", F.lit(1), room), lambda x: x["__leader"]))
    members = scratch.write(listed.select("sid", "n", F.explode(leaders).alias("bucket")), "members")
    scratch.drop("shared")
    sizes = members.groupBy("bucket").agg(F.count("*").alias("__n"), F.sum("n").alias("__t")).where("__n > 1")
    sizes = scratch.write(sizes, "buckets")
    placed = skew_safe_join(members, sizes, ["bucket"], "__n", members.count())
    big = (F.col("__n") > BUCKET) | (F.col("__t") > SHINGLES)
    placed = scratch.write(placed.select("bucket", F.when(big, _size_band(F.col("n"))).otherwise(F.lit(-1)).alias("band"), "sid", "n", big.alias("large")), "placed")
    scratch.drop("members")
    # Chunks of each band of a large bucket: a row per band, so as few as a logarithm of the sizes.
    bands = placed.where("large").groupBy("bucket", "band").agg(F.count("*").alias("__n"), F.sum("n").alias("__t"))
    chunks = F.greatest(F.ceil(F.col("__n") / BUCKET), F.ceil(F.col("__t") / SHINGLES)).cast("long")
    bands = scratch.write(bands.select("bucket", "band", "__n", chunks.alias("__chunks")), "bands")
    dealt = skew_safe_join(placed, bands, ["bucket", "band"], "__n", placed.count(), "left")
    dealt = dealt.select("bucket", "band", F.when(F.col("large"), F.pmod(F.xxhash64("sid", "bucket"), "__chunks")).otherwise(F.lit(0)).alias("chunk"), "sid", F.lit(False).alias("probe"), "large")
    # The leader is in every chunk of a large bucket.
    cells = bands.select("bucket", "band", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__chunks") - 1)).alias("chunk"))
    leader = cells.select("bucket", "band", "chunk", F.col("bucket").alias("sid"), F.lit(False).alias("probe"), F.lit(True).alias("large"))
    dealt = scratch.write(dealt.unionByName(leader).distinct(), "dealt")
    sets = full.select("sid", "n", "tokens")
    first = scratch.write(_walk(dealt.join(sets, "sid"), ["bucket", "band", "chunk"]), "walk")
    links = first.where("not loose").select("a", "b")

    loose = scratch.write(first.where("loose").select("bucket", F.col("a").alias("sid"), "band").distinct().join(full.select("sid", "n"), "sid"), "loose")
    blocks = loose.groupBy("bucket", "band").agg(F.count("*").alias("__n"), F.sum("n").alias("__t"))
    blocks = scratch.write(blocks.select("bucket", F.col("band").alias("__band"), "__n", chunks.alias("__blocks")), "blocks")
    if not blocks.isEmpty():
        # A task is a chunk and a block of loose sets whose bands can link.
        tasks = cells.join(blocks, "bucket").where(F.abs(F.col("band") - F.col("__band")) <= 1)
        tasks = scratch.write(tasks.select("bucket", "band", "chunk", "__band", "__blocks"), "tasks")
        one = loose.withColumnRenamed("band", "__band").join(blocks.select("bucket", "__band", "__blocks"), ["bucket", "__band"])
        one = one.select("bucket", "__band", "sid", F.pmod(F.xxhash64("sid"), "__blocks").alias("block"))
        probes = one.join(tasks.drop("__blocks"), ["bucket", "__band"]).select("bucket", "band", "chunk", "__band", "block", "sid", F.lit(True).alias("probe"), F.lit(True).alias("large"))
        held = dealt.where("large").join(tasks, ["bucket", "band", "chunk"]).select("bucket", "band", "chunk", "__band", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__blocks") - 1)).alias("block"), "sid", "probe", "large")
        again = held.unionByName(probes).join(sets, "sid")
        walked = scratch.write(_walk(again, ["bucket", "band", "chunk", "__band", "block"]).where("not loose").select("a", "b"), "walk-loose")
        links = links.unionByName(walked)
    return links


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row.

    Two documents link when their shingle sets meet the threshold (0.8); component_id is the smallest
    id that links reach.  Null, empty and wordless texts have no shingles and link with nothing.
    Repeated rows and equal sets link; a component without any id keeps null; other columns are
    ignored; an empty table gives an empty result.
    """
    with Scratch(docs.sparkSession, "jaccard") as scratch:
        rows = scratch.write(_set_rows(docs, id_col, text_col, 0.0).drop("tokens"), "rows")
        nodes = rows.where("n > 0").groupBy("node", "mark", "n").agg(F.min("__id").alias("__least"), F.min("__k").alias("__k"), F.count("*").alias("__copies"))
        nodes = scratch.write(nodes, "nodes")
        # Shingles of the region that one set alone has; equal sets count as one.  Making them again costs
        # less than keeping them on disk.
        region = _set_rows(docs, id_col, text_col, REGION)
        single = region.select("n", "mark", F.explode("tokens").alias("token")).groupBy("token").agg(F.min("mark").alias("mark"), F.max("mark").alias("__other"), F.min("n").alias("n")).where("mark = __other")
        single = single.groupBy("mark", "n").agg(F.count("*").alias("__single"))
        a, b = PERCENT
        length = F.col("n") - F.ceil(F.col("n") * b / a) + 1
        left = nodes.join(single, ["mark", "n"], "left").where(F.coalesce("__single", F.lit(0)) < length).select("__k")
        left = scratch.write(left, "left")
        kept = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).withColumn("__k", _row_hash("__id", "__text"))
        kept = kept.join(_within(left), "__k", "left_semi")
        full = _set_rows(kept, "__id", "__text", 1.0).dropDuplicates(["node"])
        # Numbers stand for sets from here on: unlike half a hash, no two sets share one.
        full = scratch.write(full.select(F.monotonically_increasing_id().alias("sid"), "node", "n", "tokens"), "sets")
        scratch.drop("left")
        root = components(set_links(full, scratch), scratch)
        root = root.unionByName(root.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("node", "sid")
        root = scratch.write(root.join(full.select("sid", "node"), "sid").select("node", "root"), "roots")
        least = root.join(nodes.select("node", "__least"), "node").groupBy("root").agg(F.min("__least").alias("__component"), F.count("*").alias("__members"))
        back = skew_safe_join(root, least, ["root"], "__members", root.count()).select("node", "__component")
        facts = nodes.join(back, "node", "left").where("__copies > 1 or __component is not null").select("node", F.coalesce("__component", "__least").alias("__component"), "__copies")
        facts = scratch.write(facts, "facts")
        total = int(nodes.agg(F.sum("__copies")).first()[0] or 0)
        own = rows.where("n > 0").select("__id", "n", "node")
        found = skew_safe_join(own, facts, ["node"], "__copies", total, "left")
        empty = rows.where("n = 0").select("__id", "n", F.lit(None).cast(rows.schema["__id"].dataType).alias("__component"))
        out = found.select("__id", "n", "__component").unionByName(empty)
        return scratch.result(out.select(F.col("__id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("__component", "__id").alias("component_id")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component stays, with all its columns: the one whose row key is least.

    Rows without shingles all stay, as they link with nothing; an empty table stays empty; rows equal in
    id and text count as one, of which any stays.
    """
    (rid,) = fresh(docs.columns, "__rid")
    keyed = docs.withColumn(rid, row_key(id_col, text_col))
    with Scratch(docs.sparkSession, "near-copies") as scratch:
        groups = jaccard_components(keyed.select(rid, text_col), rid, text_col)
        gone = scratch.result(groups.where(F.col("component_id") != F.col(rid)).select(rid).distinct(), "gone")
        kept = keyed.join(_within(gone), rid, "left_anti")
        # Rows equal in id and text share a key; one of them stays.
        again = scratch.result(groups.where((F.col("n_shingles") > 0) & (F.col("component_id") == F.col(rid))).groupBy(rid).count().where("count > 1").select(rid), "again")
    if not again.isEmpty():
        once = kept.join(_within(again), rid, "left_semi").dropDuplicates([rid])
        kept = kept.join(_within(again), rid, "left_anti").unionByName(once)
    return kept.select(*docs.columns)
