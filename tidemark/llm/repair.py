"""Token-ID output (operator 6): Re-Pair grammar compression of id shards, with random access.

Ids are written in ascending doc_id order. Spark deals documents to ranges of doc_id, sorts each range, and a
task turns it into shards of about ``shard_ids`` ids, so a range of any size needs the memory of one shard. An id
that fills several ranges by itself is dealt over them by the hash of its texts (up to 2**53, as quantiles are doubles,
and the null id).
Within a shard, rounds replace frequent neighbouring pairs of symbols by new symbols, each pair one rule, until
no pair is frequent enough. In a round the most frequent pairs are taken such that no symbol is the left part of
one and the right part of another, so replacements cannot overlap; a pair of equal symbols is counted and replaced
at every second place of a run, in a round in which no other pair has that symbol. The next rounds take the others. A shard's row holds its rules, its symbol string, the expansion length of every rule, and each
document's id and place. Any document is decoded from its own symbols: the symbols' expansion lengths, summed,
give where it begins, and rules expand from the top.

The files are Parquet with one row a shard, written and read by Spark, so any shared store will do.

Defined cases: a null text is empty; every document has an end id, so none is without ids. Rows that repeat a
doc_id are documents of their own, in any order among themselves. A null doc_id comes last, after an id of
2**63 - 1. A text longer than a shard makes a shard longer by itself. Further input columns are ignored; an empty
table gives files without rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import shared_path, table
from tidemark.llm.pieces import library_cache
from tidemark.llm.registry import register
from tidemark.llm.textnp import GOLDEN, blocks

END = 0
SHARD_IDS = 1 << 19
LAST = (1 << 63) - 1
CELL_BITS = 17
CACHED = 800_000  # pieces of a task's cache
SCHEMA = "part int, shard int, docs binary, nulls long, counts binary, symbols binary, rules binary, lengths binary, first_rule long, ids long"


def _cell(pair: np.ndarray) -> np.ndarray:
    return ((pair.view(np.uint64) * np.uint64(GOLDEN)) >> np.uint64(64 - CELL_BITS)).view(np.int64)


def compress(ids: np.ndarray, per_round: int = 4096, least: int = 16) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Symbols, rules (left, right) in the order of their numbers, their expansion lengths, and the first rule's number."""
    base = int(ids.max()) + 1 if len(ids) else 0
    symbols = np.append(ids.astype(np.int64), -1)  # -1: the end, in no pair
    kind = np.int32 if len(symbols) < 1 << 31 else np.int64
    after, before = np.arange(1, len(symbols) + 1, dtype=kind), np.arange(-1, len(symbols) - 1, dtype=kind)  # neighbours that are left
    there = np.ones(len(symbols), bool)
    look = np.zeros(len(symbols), bool)
    rules: list[np.ndarray] = []
    size: list[np.ndarray] = []
    count = 0
    number = np.full(1 << CELL_BITS, -1)
    live = np.arange(len(ids))  # places whose pair may stand often enough
    while len(live):
        first, second = (symbols[live], symbols[after[live]]) if count else (symbols[:-1], symbols[1:])
        pair = first << 32 | second
        same = np.flatnonzero(first == second)
        runs = live[same]
        if len(same):  # in a run only every second place from its start, so that none overlap
            order = np.arange(len(same))
            begin = np.maximum.accumulate(np.where(np.r_[True, after[runs[:-1]] != runs[1:]], order, 0))
            pair[same[(order - begin) % 2 == 1]] = -1
        # a pair that stands often enough lies in a cell with as many pairs; only those cells are sorted
        cell = _cell(pair)
        often = np.flatnonzero((np.bincount(cell, minlength=1 << CELL_BITS) >= least)[cell] & (pair >= 0))
        place, pair, cell = live[often], pair[often], cell[often]
        ordered = np.sort(pair)
        if not len(ordered):
            break
        at = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        often = np.diff(np.r_[at, len(ordered)])
        some = np.flatnonzero(often >= least)
        some = some[np.argsort(-often[some], kind="stable")][:per_round]
        side: dict[int, int] = {}
        taken = []
        for key in ordered[at[some]].tolist():
            a, b = key >> 32, key & 0xFFFFFFFF
            if a == b and a not in side:
                side[a] = 2  # in no other pair
                taken.append(key)
            elif a != b and side.get(a, 0) == 0 and side.get(b, 1) == 1:
                side[a], side[b] = 0, 1
                taken.append(key)
        if not taken:
            break
        taken = np.array(taken, np.int64)
        own = _cell(taken)
        number[own[::-1]] = np.arange(len(taken))[::-1]
        taken = taken[number[own] == np.arange(len(taken))]  # of two in a cell the less frequent one waits for a later round
        own = _cell(taken)
        number[own] = np.arange(len(taken))
        near = number[cell]
        found = np.flatnonzero(near >= 0)
        found = found[taken[near[found]] == pair[found]]
        hit, near = place[found], near[found]
        number[own] = -1
        new = base + count + near
        symbols[hit] = new
        gone = after[hit]
        there[gone] = False
        after[hit] = after[gone]
        before[after[gone]] = hit
        # no pair of old symbols gains a place: the next round looks where this one found many, at runs and beside new symbols
        look[place] = look[runs] = look[hit] = look[before[hit]] = True
        look[gone] = False
        live = np.flatnonzero(look[:-1])
        look[live] = False
        left, right = taken >> 32, taken & 0xFFFFFFFF
        have = np.concatenate(size) if size else np.zeros(0, np.int64)
        long = lambda s: np.where(s < base, 1, have[np.maximum(s - base, 0)] if len(have) else 1)  # noqa: E731, B023
        size.append(long(left) + long(right))
        rules.append(np.stack([left, right], 1))
        count += len(taken)
    empty = np.zeros((0, 2), np.int64)
    return symbols[:-1][there[:-1]], np.concatenate(rules) if rules else empty, np.concatenate(size) if size else empty[:, 0], base


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """Ids of a stretch of symbols. Of many symbols, each rule's ids are made once and copied to its places."""
    if len(symbols) <= len(rules) or not len(rules):
        return _expand(symbols, rules, lengths, base)
    rule = symbols >= base
    number = np.where(rule, symbols - base, 0)
    size = np.where(rule, lengths[number], 1)
    ends = np.cumsum(size)
    if lengths.sum() > ends[-1]:  # rules longer than all that they stand for here
        return _expand(symbols, rules, lengths, base)
    parts = _expand(np.arange(base, base + len(rules)), rules, lengths, base)
    begin = np.where(rule, (np.cumsum(lengths) - lengths)[number], len(parts) + np.arange(len(symbols)))
    return np.concatenate([parts, symbols])[np.repeat(begin - (ends - size), size) + np.arange(int(ends[-1]))]


def _expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """Ids go to their places, rules on to their two parts, until only ids are left."""
    size = np.where(symbols < base, 1, lengths[np.maximum(symbols - base, 0)] if len(lengths) else 1)
    out = np.empty(int(size.sum()), np.int64)
    at = np.cumsum(size) - size
    while len(symbols):
        rule = symbols >= base
        out[at[~rule]] = symbols[~rule]
        left, right = rules[symbols[rule] - base].T
        at, symbols = at[rule], np.concatenate([left, right])
        at = np.concatenate([at, at + np.where(left < base, 1, lengths[np.maximum(left - base, 0)] if len(lengths) else 1)])
    return out


def read_range(row, lo: int, hi: int) -> np.ndarray:
    """Ids ``lo`` to ``hi`` of one shard row, expanding only the symbols that hold them."""
    symbols, rules, lengths, base = _shard(row["symbols"], row["rules"], row["lengths"], row["first_rule"])
    size = np.where(symbols < base, 1, lengths[np.maximum(symbols - base, 0)] if len(lengths) else 1)
    ends = np.cumsum(size)
    a, b = np.searchsorted(ends, lo, "right"), np.searchsorted(ends, hi, "left") + 1
    begin = int(ends[a - 1]) if a else 0
    return expand(symbols[a:b], rules, lengths, base)[lo - begin:hi - begin]


def _shard(symbols: bytes, rules: bytes, lengths: bytes, base: int):
    return (np.frombuffer(symbols, "<u4").astype(np.int64), np.frombuffer(rules, "<u4").astype(np.int64).reshape(-1, 2),
            np.frombuffer(lengths, "<u4").astype(np.int64), base)


def write_ids(docs: DataFrame, out_path: str, path: str, end: int = END, id_col: str = "doc_id", text_col: str = "text",
              shard_ids: int = SHARD_IDS) -> None:
    """Encode, compress and write all documents to ``out_path``."""
    spark = docs.sparkSession
    own = F.col(id_col).cast("long")
    docs = docs.select(F.coalesce(own, F.lit(LAST)).alias("doc_id"), own.isNull().alias("no_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # range bounds from the ids alone, so that texts are read once
    bounds = docs.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 100 * parts)).first()[0]
    bounds = np.array(sorted(bounds or []), np.int64)

    @F.pandas_udf("int")
    def part_of(ids, no_id, spread):
        import pandas as pd
        key = ids.to_numpy(np.int64)
        first = np.searchsorted(bounds, key, "left")
        # an id that is a bound several times has as many ranges; 2**63 - 1 stays in the first, before the nulls
        share = np.where((key == LAST) & ~no_id.to_numpy(bool), 1, np.maximum(np.searchsorted(bounds, key, "right") - first, 1))
        return pd.Series((first + spread.to_numpy(np.int64) % share).astype(np.int32))

    def shard(batches):
        part, number, held, docs_, counts, total, nulls = -1, 0, [], [], [], 0, 0

        def flush():
            nonlocal number, held, docs_, counts, total, nulls
            ids = np.concatenate(held)
            symbols, rules, lengths, base = compress(ids)
            row = [[part], [number], [np.concatenate(docs_).astype("<i8").tobytes()], [nulls],
                   [np.concatenate(counts).astype("<u4").tobytes()], [symbols.astype("<u4").tobytes()],
                   [rules.astype("<u4").tobytes()], [lengths.astype("<u4").tobytes()], [base], [len(ids)]]
            number, held, docs_, counts, total, nulls = number + 1, [], [], [], 0, 0
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.int64(), *[pa.binary()] * 4, pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(row, kinds)],
                                              names=[f.split()[0] for f in SCHEMA.split(", ")])

        for b in blocks(batches):
            own = b.column("part").to_numpy()
            for p in np.unique(own).tolist():
                at = np.flatnonzero(own == p)
                rows = b.slice(int(at[0]), len(at))
                if p != part:
                    if held:
                        yield flush()
                    part, number = p, 0
                ids, n = library_cache(path, CACHED).encode(rows.column("text").to_pylist())
                held.append(np.insert(ids, np.cumsum(n), end))
                docs_.append(rows.column("doc_id").to_numpy())
                counts.append(n + 1)
                nulls += pc.sum(rows.column("no_id")).as_py()
                total += len(held[-1])
                if total >= shard_ids:
                    yield flush()
        if held:
            yield flush()

    # part i is partition i
    (docs.withColumn("part", part_of("doc_id", "no_id", F.xxhash64("text"))).repartitionById(parts, F.col("part"))
     .sortWithinPartitions("part", "doc_id", "no_id")
     .mapInArrow(shard, SCHEMA).write.parquet(out_path))


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if asked for, ids of every document in the files at ``path``."""
    shards = spark.read.schema(SCHEMA).parquet(path)
    sums = shards.select("part", "shard", "ids")
    part = sums.groupBy("part").agg(F.sum("ids").alias("n"))  # one row for each of a fixed number of ranges
    ahead = part.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("p"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("part", "shard", F.coalesce(F.sum("ids").over(inside), F.lit(0)).alias("s")).join(ahead, "part").select(
        "part", "shard", (F.col("p") + F.col("s")).alias("base"))

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                row = {n: b.column(n)[r].as_py() for n in b.schema.names}
                ids = expand(*_shard(row["symbols"], row["rules"], row["lengths"], row["first_rule"])).astype("<u4")
                docs, n = np.frombuffer(row["docs"], "<i8"), np.frombuffer(row["counts"], "<u4").astype(np.int64)
                cut = np.r_[0, np.cumsum(n)]
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * x:4 * y]) for x, y in zip(cut[:-1].tolist(), cut[1:].tolist())]
                known = pa.array(docs, pa.int64(), mask=np.arange(len(docs)) >= len(docs) - row["nulls"])  # nulls are sorted last
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * len(n), pa.int32()), pa.array([row["shard"]] * len(n), pa.int32()), known,
                     pa.array(cut[:-1]), pa.array(n), pa.array(crc, pa.int64()),
                     *([pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(ids.astype(np.int32)))] if with_ids else [])],
                    names=["part", "shard", "doc_id", "at", "n_tokens", "ids_crc32", *own])

    own = ["ids"] if with_ids else []
    rows = shards.mapInArrow(run, "part int, shard int, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)
    return rows.join(base, ["part", "shard"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens",
                                                     "ids_crc32", *own)


@register("op6_repair")
def op6_repair(spark, sf_dir):
    path = shared_path(spark, "ids")
    write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_ids(spark, path, with_ids=False)
