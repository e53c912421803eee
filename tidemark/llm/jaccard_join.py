"""N-gram Jaccard join (operator 1): a prefix filter finds candidates, a prefix tree joins them.

The global order of shingles is (how full the shingle's bucket is in a fixed-size count of all shingles of
all documents, hash): rare ones first. Links need ``den * |A and B| >= num * |A or B|``; then the first
``|A| - ceil(t |A|) + 1`` shingles of the two sets share one. The count only sets the order: it makes
shingles of common passages come last, and any order gives the same links.

1. every document's set (as sorted 64-bit hashes) gives its size, a 128-bit class and its prefix; equal
   sets are one class from here on, so copies are never paired;
2. classes that share a prefix shingle are all joined to that shingle's smallest class, so the two sides of
   every link meet around one such leader. There, sizes and parity sketches (bit ``hash mod 2**w`` is the
   parity of the set's hashes there; two sketches differ in at most as many bits as the sets differ in
   shingles) leave out pairs that cannot be linked. Connected components of what is left are candidate
   groups: all links lie inside them;
3. a leader's or candidate group is cut into blocks of ``block`` sets, and each pair of blocks is one task, so a group
   of any size is spread out and nothing is left out;
4. a task stores its sets in a prefix tree, the most common shingles first, so near copies share long
   paths; each set walks the tree once, adding the overlap of shared paths once for all sets below, and
   leaves a subtree when overlap plus what remains on either side cannot reach the bound, when the sizes
   below cannot match, or when everything below is already connected to it;
5. the links found (a spanning set) give the components.

Defined cases: words are maximal runs outside the six white-space characters, A-Z lower-cased; a text of
fewer than ``n`` words has its whole sequence as its only shingle; without words (or null) the set is empty
and linked with nothing. Rows that repeat a doc_id are documents of their own with equal ids. A null doc_id
counts as larger than any and comes out null. Texts of any length are read whole; an empty table gives no rows.
Further input columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ids_and_text, let_go, stored, table
from tidemark.llm.components import by_key, components, in_blocks
from tidemark.llm.registry import register
from tidemark.llm.textnp import blocks, mix, salt, shingle_sets

COUNT_BITS = 22
PARTS = 64
BRANCHES = 32
BLOCK = 2000


# ---------------------------------------------------------------- order of shingles

def _bucket_counts(docs: DataFrame, n: int) -> np.ndarray:
    """How many sets have a shingle in each of 2**COUNT_BITS buckets: a table of fixed size."""
    size = 1 << COUNT_BITS
    width = size // PARTS

    def count(batches):
        total = np.zeros(size, np.uint32)
        for b in blocks(batches):
            value, _ = shingle_sets(b.column("text"), n)
            np.add.at(total, (value >> np.uint64(64 - COUNT_BITS)).astype(np.int64), 1)
        parts = [total[p * width:(p + 1) * width] for p in range(PARTS)]
        have = [p for p in range(PARTS) if parts[p].any()]
        yield pa.RecordBatch.from_arrays([pa.array(have, pa.int32()),
                                          pa.array([TaskContext.get().partitionId() % BRANCHES] * len(have), pa.int32()),
                                          pa.array([parts[p].tobytes() for p in have], pa.binary())],
                                         names=["part", "branch", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(width, np.uint32)
        for x in group["counts"]:
            have = np.frombuffer(x.as_py(), np.uint32)
            total = np.where(total > np.iinfo(np.uint32).max - have, np.iinfo(np.uint32).max, total + have)
        return pa.table({"part": pa.array([group["part"][0].as_py()], pa.int32()),
                         "branch": pa.array([0], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    ddl = "part int, branch int, counts binary"
    summed = (docs.select("text").mapInArrow(count, ddl).groupBy("part", "branch").applyInArrow(add, ddl)
              .groupBy("part").applyInArrow(add, ddl))
    out = np.zeros((PARTS, width), np.uint32)
    for row in summed.toLocalIterator():  # PARTS rows of a fixed size
        out[row["part"]] = np.frombuffer(row["counts"], np.uint32)
    return np.minimum(out.reshape(-1), 65535).astype(np.uint16)


def _in_order(value: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One set's ascending hashes in the global order."""
    return value[np.argsort(counts[(value >> np.uint64(64 - COUNT_BITS)).astype(np.int64)], kind="stable")]


def _class_of(value: np.ndarray, cut: np.ndarray) -> list[bytes]:
    """128 bits that name each set: two sums of mixed hashes, with the size in both."""
    out = np.zeros((len(cut) - 1, 2), np.uint64)
    size = np.diff(cut).astype(np.uint64)
    for i in range(2):
        total = np.zeros(len(value) + 1, np.uint64)
        np.cumsum(mix(value ^ salt(11 + i)), out=total[1:])
        out[:, i] = mix(total[cut[1:]] - total[cut[:-1]] + size * salt(21 + i))
    raw = out.astype(">u8").tobytes()
    return [raw[i:i + 16] for i in range(0, len(raw), 16)]


# ---------------------------------------------------------------- parity sketches

def _sketches(value: np.ndarray, cut: np.ndarray) -> list[bytes]:
    """Each set's parity sketch, of two to four bits for each of its shingles."""
    out = []
    for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
        bits = max(512, 1 << (2 * (hi - lo) - 1).bit_length()) if hi > lo else 512
        odd = np.bincount((value[lo:hi] & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
        out.append(np.packbits(odd.astype(np.uint8), bitorder="little").tobytes())
    return out


def maybe_links(sizes: np.ndarray, sketches: list[bytes], num: int, den: int) -> list[tuple[int, int]]:
    """Pairs (indexes) that connect what sizes and sketches do not rule out."""
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    raw = [np.frombuffer(sketches[i], np.uint64) for i in order]
    width = np.array([len(r) for r in raw])
    label = np.arange(len(raw))
    out = []
    # one matrix for each width, and what is wider by one step folded onto it
    for w in np.unique(width):
        own, wide = np.flatnonzero(width == w), np.flatnonzero(width == 2 * w)
        at = np.concatenate([own, wide])
        bits = np.stack([raw[i] for i in own] + [raw[i][:w] ^ raw[i][w:] for i in wide])
        size, lab = sizes[at], label[at]
        for k in range(len(own)):
            most = den * size[k] // num
            end = int(np.searchsorted(size, most, "right"))
            rest = np.arange(k + 1, end)
            rest = rest[lab[rest] != lab[k]]
            if not len(rest):
                continue
            both = size[k] + size[rest]
            apart = both - 2 * (-(-num * both // (num + den)))  # largest difference of two linked sets
            rest = rest[np.bitwise_count(bits[rest] ^ bits[k]).sum(1, dtype=np.int64) <= apart]
            for r in rest.tolist():
                if lab[r] != lab[k]:
                    out.append((int(order[at[k]]), int(order[at[r]])))
                    label[label == lab[r]] = lab[k]
                    lab = label[at]
    return out


# ---------------------------------------------------------------- the join of one task

class _Node:
    __slots__ = ("seg", "depth", "last", "small", "large", "kids", "sets", "one", "below")

    def __init__(self, seg, depth, last):
        self.seg, self.depth, self.last = seg, depth, last  # shingles on this edge; path length; largest shingle so far
        self.small, self.large = 1 << 62, 0  # sizes of the sets below
        self.kids, self.sets, self.one = [], [], -1  # one: a set below, once all below are known to be connected
        self.below = None  # the kids' edges end to end, where each begins, and their small, large, depth and last


def _tree(sets: list[np.ndarray]) -> _Node:
    """Prefix tree with one edge a run: sets in lexicographic order, each branching off the path of the one before."""
    big = [s.astype(">u4").tobytes() for s in sets]
    order = sorted(range(len(sets)), key=big.__getitem__)
    root = _Node(np.zeros(0, np.uint32), 0, -1)
    path = [root]
    before = np.zeros(0, np.uint32)
    for i in order:
        s = sets[i]
        m = min(len(s), len(before))
        differ = np.flatnonzero(s[:m] != before[:m])
        common = int(differ[0]) if len(differ) else m
        while path[-1].depth > common and path[-2].depth >= common:
            path.pop()
        top = path[-1]
        if top.depth > common:  # split its edge
            up = path[-2]
            start = up.depth
            mid = _Node(top.seg[:common - start], common, int(top.seg[common - start - 1]))
            top.seg = top.seg[common - start:]
            mid.kids = [top]
            up.kids[-1] = mid
            path[-1] = mid
            top = mid
        if len(s) > common:
            leaf = _Node(s[common:], len(s), int(s[-1]))
            top.kids.append(leaf)
            path.append(leaf)
            top = leaf
        top.sets.append(i)
        before = s
    stack = [(root, False)]
    while stack:
        node, done = stack.pop()
        if not done:
            stack.append((node, True))
            stack.extend((k, False) for k in node.kids)
        else:
            sizes = [node.depth] * bool(node.sets) + [k.small for k in node.kids]
            node.small = min(sizes, default=node.depth)
            node.large = max([node.depth] * bool(node.sets) + [k.large for k in node.kids], default=node.depth)
            if node.kids:
                node.below = (np.concatenate([k.seg for k in node.kids]),
                              np.cumsum([0] + [len(k.seg) for k in node.kids[:-1]]),
                              *np.array([(k.small, k.large, k.depth, k.last) for k in node.kids]).T)
    return root


def trie_links(sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Links (indexes) that connect what the bound connects. ``sets``: distinct shingles, each ascending."""
    vocabulary = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
    inside = np.zeros(len(vocabulary), bool)
    sets = [np.searchsorted(vocabulary, s).astype(np.uint32) for s in sets]
    # common shingles first: the order of the tree, the same for all sets
    often = np.zeros(len(vocabulary), np.int64)
    for s in sets:
        often[s] += 1
    rank = np.empty(len(vocabulary), np.uint32)
    rank[np.argsort(-often, kind="stable")] = np.arange(len(vocabulary), dtype=np.uint32)
    sets = [np.sort(rank[s]) for s in sets]
    root = _tree(sets)
    up = list(range(len(sets)))

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    links = []

    def connected(node, own):
        return node.one >= 0 and find(node.one) == own

    for x, own_set in enumerate(sets):
        size = len(own_set)
        if not size or connected(root, find(x)):
            continue
        inside[own_set] = True
        least, most = -(-num * size // den), den * size // num
        stack = [(root, 0, False)]
        while stack:
            node, overlap, done = stack.pop()
            if done:  # all below visited: remember if it is one component
                ones = [node.sets[0]] if node.sets else []
                ones += [k.one for k in node.kids]
                if -1 not in ones and len({find(i) for i in [*node.sets, *ones]}) == 1:
                    node.one = ones[0]
                continue
            if connected(node, find(x)):
                continue
            if node.sets and overlap * (num + den) >= num * (size + node.depth):
                for y in node.sets:
                    a, b = find(x), find(y)
                    if a != b:
                        up[max(a, b)] = min(a, b)
                        links.append((x, y))
            stack.append((node, overlap, True))
            if node.kids:  # bounds of all kids at once
                flat, begin, small, large, depth, last = node.below
                sums = overlap + np.add.reduceat(inside[flat], begin, dtype=np.int64)
                need = -(-num * (size + np.maximum(small, least)) // (num + den))
                rest = size - np.searchsorted(own_set, last, "right")
                go = (large >= least) & (small <= most) & (sums + np.minimum(rest, large - depth) >= need)
                stack.extend((node.kids[k], int(sums[k]), False) for k in np.flatnonzero(go))
        inside[own_set] = False
    return links


# ---------------------------------------------------------------- the operator

def jaccard_components(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                       text_col: str = "text", block: int = BLOCK, carry: list[str] | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` and the columns of ``carry``: sets of ``n``-word shingles are linked when
    ``den * intersection >= num * union``; the component is named by its smallest doc_id."""
    if not den <= 2 * num <= 2 * den:
        raise ValueError("the bound lies between 1/2 and 1")  # sketches of linked sets are at most one step apart
    spark = docs.sparkSession
    carry = carry or []
    docs = ids_and_text(docs, id_col, text_col, carry)
    counts = spark.sparkContext.broadcast(_bucket_counts(docs, n))  # 2**COUNT_BITS short integers

    def describe(batches):
        for b in blocks(batches):
            value, cut = shingle_sets(b.column("text"), n)
            prefix, ends = [], [0]
            for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
                size = hi - lo
                if size:
                    prefix.append(_in_order(value[lo:hi], counts.value)[:size - -(-num * size // den) + 1])
                ends.append(ends[-1] + (len(prefix[-1]) if size else 0))
            flat = np.concatenate(prefix).view(np.int64) if prefix else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(_class_of(value, cut), pa.binary()), pa.array(np.diff(cut).astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                 pa.array(_sketches(value, cut), pa.binary()), *[b.column(c) for c in carry]],
                names=["doc_id", "class", "n", "prefix", "sketch", *carry])

    shape = spark.createDataFrame([], "doc_id long, class binary, n long, prefix array<long>, sketch binary").schema
    rows = stored(docs.mapInArrow(describe, T.StructType([*shape, *[docs.schema[c] for c in carry]])), "sets")
    full = rows.where("n > 0")
    classes = full.groupBy("class").agg(F.min("doc_id").alias("rep"), F.any_value("prefix").alias("prefix"))
    tokens = classes.select("class", F.explode("prefix").alias("token"))
    first = (tokens.groupBy("token").agg(F.min("class").alias("b"), F.max("class").alias("z")).where("b <> z")
             .select("token", "b"))
    near = by_key(tokens, first, "token").select("class", F.col("b").alias("root")).distinct()

    def maybe(group: pa.Table) -> pa.Table:
        names = group["class"].to_pylist()
        own = {c: k for k, c in enumerate(names)}
        names = sorted(own)
        at = [own[c] for c in names]
        links = maybe_links(group["n"].to_numpy()[at], group["sketch"].take(pa.array(at)).to_pylist(), num, den)
        return pa.table({"a": pa.array([names[x] for x, _ in links], pa.binary()),
                         "b": pa.array([names[y] for _, y in links], pa.binary())})

    around = near.groupBy("root").agg(F.count(F.lit(1)).alias("g"))
    looks = full.groupBy("class").agg(F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch"))
    met = in_blocks(by_key(by_key(near, around, "root"), looks, "class"), block)
    groups = components(met.groupBy("root", "i", "j").applyInArrow(maybe, "a binary, b binary"))
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("g"))
    live = stored(by_key(by_key(groups.withColumnRenamed("id", "class"),
                                full.groupBy("class").agg(F.min("doc_id").alias("rep")), "class"), sizes, "root"), "live")

    let_go(spark)

    def sets_of(batches):
        for b in blocks(batches):
            value, cut = shingle_sets(b.column("text"), n)
            cut32 = pa.array((cut * 8).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(_class_of(value, cut), pa.binary()),
                 pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, cut32.buffers()[1], pa.py_buffer(value.tobytes())])],
                names=["class", "shingles"])

    reps = live.select("rep").distinct()
    picked = docs.select("doc_id", "text").join(reps, F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")  # a class of null ids only has none else
    sets = by_key(picked.mapInArrow(sets_of, "class binary, shingles binary"), live, "class")
    def join(group: pa.Table) -> pa.Table:
        own = dict(zip(group["class"].to_pylist(), group["shingles"].to_pylist()))
        names = sorted(own)
        links = trie_links([np.frombuffer(own[c], np.uint64) for c in names], num, den)
        return pa.table({"a": pa.array([names[x] for x, _ in links], pa.binary()),
                         "b": pa.array([names[y] for _, y in links], pa.binary())})

    links = in_blocks(sets, block).groupBy("root", "i", "j").applyInArrow(join, "a binary, b binary")
    linked = components(links).withColumnRenamed("id", "class")
    reps = full.groupBy("class").agg(F.min("doc_id").alias("rep"))
    rooted = by_key(reps, linked, "class", "left").select("class", "rep", F.coalesce("root", "class").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = by_key(rooted, smallest, "root").select("class", "component_id")
    out = by_key(full.select("doc_id", "class", "n", *carry), named, "class").select("doc_id", "n", "component_id", *carry).unionByName(
        rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"), *carry))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", *carry)


@register("op1_jaccard_trie", r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
g AS (SELECT doc_id, words, unnest(CASE WHEN len(words) = 0 THEN [] ELSE range(1, greatest(len(words) - 1, 2)) END) AS i FROM w),
s AS (SELECT DISTINCT doc_id, list_aggregate(words[i:i + 2], 'string_agg', ' ') AS t FROM g),
n AS (SELECT w.doc_id, count(s.t) AS n FROM w LEFT JOIN s ON w.doc_id = s.doc_id GROUP BY w.doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * o >= 90 * (p.n + q.n - o)),
r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT n.doc_id, n.n AS n_shingles, m.component_id FROM n JOIN (SELECT x, min(y) AS component_id FROM r GROUP BY x) m ON m.x = n.doc_id""")
def op1_jaccard_trie(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"), n=3, num=90, den=100)
