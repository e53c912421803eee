"""Best-fit packing (operator 5) with Martello-Toth dominance reduction.

A document's ids are cut into pieces of at most ``capacity``; pieces are packed into as few sequences as the
method finds. All that packing depends on is how many pieces there are of each length, a table of at most
``capacity`` rows at any size of corpus. On it:

1. dominance: for each length, longest first, the set of at most three pieces that is at least as good as any other
   set with such a piece is looked for by the tests in ``dominating`` and, if there is one, fixed as often as its
   pieces are there. A length on which the tests fail is passed over and tried again when others were fixed;
2. the rest goes best fit, longest first: each piece into the fullest sequence that takes it. Sequences of
   equal room and pieces of equal length are handled as one batch, with the outcome of the one-by-one order.

The result is a list of runs: so many pieces of a length, in order, go to so many sequences at an offset. Its
size is bounded by the lengths, not the pieces. Pieces are numbered within their length (in buckets, so a
length that very many pieces share is not one task) and find their run by binary search in a table sent to
the tasks.

Defined cases: a null text is empty; an empty text still has its end id, a piece of length 1. Rows that repeat
a doc_id, or have none, are packed each. Very long texts are cut into pieces; an empty table gives no rows. Further input
columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ids_and_text, stored, table
from tidemark.llm.pieces import library_cache
from tidemark.llm.registry import register
from tidemark.llm.textnp import blocks

CAPACITY = 4096
END = 1
ROWS_PER_BUCKET = 100_000


def dominating(left: dict[int, int], capacity: int):
    """Sets of at most three lengths that dominate all other sets with their first length, one after the other; the
    caller takes them from ``left`` as often as they are there, which keeps their dominance: fewer sets are left.

    For a piece n let b be the longest piece that fits beside it, and y the longest that fits beside both. n alone
    dominates if there is no b; n with b if b fills the sequence, or no three fit beside n and no two give more
    than b; n with b and y if no three fit beside n, and any two that fit have the shorter one at most as long as y
    or give no more than b together. Lengths on which all tests fail are tried again after others were fixed."""
    order, again = sorted(left), True
    while again:
        again = False
        for n in order[::-1]:
            while n in left and (found := _dominating(n, order, left, capacity)):
                again = True
                yield found
                for x in set(found) - left.keys():
                    order.pop(bisect.bisect_left(order, x))


def _dominating(n: int, order: list[int], left: dict[int, int], capacity: int) -> tuple[int, ...] | None:
    room = capacity - n
    end = bisect.bisect_right(order, room)
    if end and order[end - 1] == n and left[n] == 1:
        end -= 1
    if not end:
        return (n,)
    b = order[end - 1]
    least = [x for x in order[:min(end, 4)] for _ in range(min(left[x] - (x == n), 3))][:3]
    if b == room or len(least) < 2 or least[0] + least[1] > room:
        return n, b
    if len(least) > 2 and sum(least) <= room:
        return None
    others = np.array([x for x in order[:end] if left[x] > (x == n)], np.int64)
    many = np.array([left[x] - (x == n) for x in others.tolist()], np.int64)
    # the longest p beside each shorter q, q <= p
    at = np.searchsorted(others, room - others, "right") - 1
    at = np.where(at == np.arange(len(others)), at - (many[np.maximum(at, 0)] < 2), at)
    fits = at >= np.arange(len(others))
    q, best = others[fits], others[fits] + others[at[fits]]
    if not (best > b).any():
        return n, b
    beside = others[(others <= room - b) & (many > (others == b))]
    if len(beside) and not (best[q > beside[-1]] > b).any():
        return n, b, int(beside[-1])
    return None


def fixed(runs: list, room: dict, together: tuple[int, ...], left: dict[int, int], capacity: int, first: int) -> int:
    """Places ``together`` in as many sequences as it can fill, from ``first`` on; gives their number."""
    each = {n: together.count(n) for n in together}
    times, offset = min(left[n] // k for n, k in each.items()), 0
    for n, k in each.items():
        runs.append((n, k * times, first, k, offset))
        offset += k * n
        left[n] -= k * times
        if not left[n]:
            del left[n]
    if rest := capacity - offset:
        room.setdefault(rest, []).append((first, times))
    return times


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs (length, pieces, first sequence, pieces a sequence, offset) and the number of sequences."""
    left = {n: c for n, c in counts.items() if c}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("lengths lie between 1 and the capacity")
    runs: list[tuple[int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> (first sequence, sequences)
    used = 0

    for together in dominating(left, capacity):
        used += fixed(runs, room, together, left, capacity, used)
    rooms = sorted(room)
    for n in sorted(left, reverse=True):  # best fit, longest first
        todo = left[n]
        while todo:
            at = bisect.bisect_left(rooms, n)
            if at == len(rooms):
                each = capacity // n
                bins = todo // each
                if not bins:
                    bins, each = 1, todo
                first, free = used, capacity
                used += bins
            else:
                free = rooms[at]
                first, have = room[free].pop()
                if not room[free]:
                    del room[free]
                    rooms.pop(at)
                each = free // n
                bins = min(have, todo // each)
                if not bins:
                    bins, each = 1, todo
                if have > bins:
                    if free not in room:
                        bisect.insort(rooms, free)
                    room.setdefault(free, []).append((first + bins, have - bins))
            runs.append((n, bins * each, first, each, capacity - free))
            todo -= bins * each
            if rest := free - each * n:
                if rest not in room:
                    bisect.insort(rooms, rest)
                room.setdefault(rest, []).append((first, bins))
    return runs, used


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece of every document."""

    def run(batches):
        for b in blocks(batches):
            ids, counts = library_cache(path).encode(b.column("text").to_pylist())
            cut = np.cumsum(counts)
            ids = np.insert(ids, cut, end).astype("<u4")  # the end id after each document
            size = counts + 1
            first = np.r_[0, np.cumsum(size)[:-1]]
            each = -(-size // capacity)
            row = np.repeat(np.arange(len(size)), each)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
            start = piece * capacity
            length = np.minimum(capacity, size[row] - start)
            at = first[row] + start
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
            cols = [b.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.ListArray.from_arrays(pa.array(np.r_[at, len(ids)].astype(np.int32)), pa.array(ids.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return ids_and_text(docs, id_col, text_col).mapInArrow(run, kind)


def pack(rows: DataFrame, capacity: int = CAPACITY, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``rows`` (doc_id, piece, length, ...; read twice, so stored) with sequence_id and offset."""
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
    runs, _ = plan(counts, capacity)
    runs.sort(key=lambda r: r[0])  # stable: runs of a length keep their order
    length, many, first, each, offset = (np.array([r[i] for r in runs], np.int64) for i in range(5))
    before = np.cumsum(many) - many
    new = np.r_[True, length[1:] != length[:-1]] if len(length) else np.zeros(0, bool)
    before -= np.repeat(before[new], np.diff(np.r_[np.flatnonzero(new), len(length)])) if len(length) else 0
    key = (length << 44) + before  # 2**44 pieces of a length
    buckets = 1 + max(counts.values(), default=0) // rows_per_bucket
    rows = rows.withColumn("_b", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    inside = Window.partitionBy("length", "_b").orderBy("doc_id", "piece", *[c for c in ("start", "ids_crc32") if c in rows.columns])
    sizes = rows.groupBy("length", "_b").agg(F.count(F.lit(1)).alias("n"))
    above = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("length", "_b", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("_base"))
    ranked = rows.withColumn("_rank", F.row_number().over(inside) - 1).join(base, ["length", "_b"])

    @F.pandas_udf("sequence_id long, offset long")
    def place(n, rank):
        import pandas as pd
        n, rank = n.to_numpy(), rank.to_numpy()
        at = np.searchsorted(key, (n << 44) + rank, "right") - 1
        k = rank - before[at]
        return pd.DataFrame({"sequence_id": first[at] + k // each[at], "offset": offset[at] + k % each[at] * n})

    placed = ranked.withColumn("_p", place(F.col("length"), F.col("_base") + F.col("_rank")))
    return placed.select(*[c for c in rows.columns if c != "_b"], "_p.sequence_id", "_p.offset")


def write_sequences(docs: DataFrame, out_path: str, path: str, capacity: int = CAPACITY, end: int = END) -> None:
    """Write the packed sequences (sequence_id, ids of its pieces in order) of at most ``capacity`` ids as Parquet."""
    rows = stored(pieces(docs, path, capacity, end, with_ids=True), "pieces")
    packed = pack(rows, capacity).groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids"))).alias("s"))
    packed.select("sequence_id", F.flatten(F.transform("s", lambda x: x["ids"])).alias("ids"),
                  F.transform("s", lambda x: F.struct(x["offset"].alias("offset"), x["doc_id"].alias("doc_id"), x["piece"].alias("piece"))).alias("pieces")
                  ).write.parquet(out_path)


@register("op5_martello_toth")
def op5_martello_toth(spark, sf_dir):
    rows = pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pack(stored(rows, "pieces"))
