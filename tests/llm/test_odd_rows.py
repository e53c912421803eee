"""Ids that are null, repeated, hot or as large as a long can be; dominance of packing against all packings."""

import functools
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from tidemark.llm import jaccard_join, packing, repair, sharding, substring_dedup

TOP = (1 << 63) - 1
LONG = "one two three four five six seven eight nine ten eleven twelve"


def _optimum(sizes, capacity):
    """Fewest sequences, by trying every set with the longest piece."""
    @functools.lru_cache(None)
    def best(left):
        if not left:
            return 0
        first, rest = left[-1], left[:-1]
        out = len(left)
        for take in range(1 << len(rest)):
            own = [x for i, x in enumerate(rest) if take >> i & 1]
            if first + sum(own) <= capacity:
                out = min(out, 1 + best(tuple(x for i, x in enumerate(rest) if not take >> i & 1)))
        return out
    return best(tuple(sorted(sizes)))


@pytest.mark.parametrize("low, high, capacity", [(1, 21, 20), (5, 18, 20), (6, 15, 20), (7, 30, 30), (8, 24, 30)])
def test_dominance_keeps_the_optimum(low, high, capacity):
    rng = np.random.default_rng(low)
    fixed = triples = 0
    for _ in range(150):
        sizes = [int(x) for x in rng.integers(low, min(high, capacity + 1), rng.integers(1, 9))]
        left = {n: sizes.count(n) for n in sizes}
        runs, room, used = [], {}, 0
        for together in packing.dominating(left, capacity):
            triples += len(together) == 3
            used += packing.fixed(runs, room, together, left, capacity, used)
        rest = [n for n, k in left.items() for _ in range(k)]
        assert used + _optimum(rest, capacity) == _optimum(sizes, capacity)
        assert sum(m for _, m, _, _, _ in runs) + len(rest) == len(sizes)
        fixed += len(sizes) - len(rest)
    assert fixed > 100 and (low < 5 or triples)


def test_dominance_goes_on_past_a_length_that_fails():
    counts = {10: 2, 2: 9, 17: 3, 3: 3}
    assert next(iter(packing.dominating(dict(counts), 20))) == (17, 3)
    left = {11: 1, 2: 9, 18: 1}
    assert (18, 2) in list(_take(left, 20))


def _take(left, capacity):
    for together in packing.dominating(left, capacity):
        yield together
        packing.fixed([], {}, together, left, capacity, 0)


def _odd(spark):
    rows = [(TOP, LONG), (None, LONG + " a"), (None, None), (3, LONG), (3, LONG + " b"), (3, ""), (None, LONG), (TOP, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


def test_largest_id_is_not_null(spark, tmp_path):
    docs, rows = _odd(spark)
    got = jaccard_join.jaccard_components(docs.where("doc_id is null or doc_id > 3"), n=3, num=90, den=100)
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got.collect()) == sorted(
        [(str(TOP), 10, str(TOP)), ("None", 11, str(TOP)), ("None", 10, str(TOP)), ("None", 0, "None"), (str(TOP), 1, str(TOP))])
    only = jaccard_join.jaccard_components(docs.where("doc_id is null"), n=3, num=90, den=100).collect()
    assert len(only) == 3 and all(r["component_id"] is None for r in only)
    out = str(tmp_path / "ids")
    repair.write_ids(docs, out, P.path("byte_bpe_50k.json"))
    back = repair.read_ids(spark, out).collect()
    tok = {t: [*repair.library_cache(P.path("byte_bpe_50k.json")).encode([t or ""])[0].tolist(), 0] for _, t in rows}
    assert sorted((str(r["doc_id"]), r["ids"]) for r in back) == sorted((str(i), tok[t]) for i, t in rows)
    placed = sorted(back, key=lambda r: r["start"])
    assert [r["doc_id"] for r in placed] == [3, 3, 3, TOP, TOP, None, None, None]
    assert [r["start"] for r in placed] == np.cumsum([0, *[r["n_tokens"] for r in placed]])[:-1].tolist()
    empty = str(tmp_path / "none")
    repair.write_ids(docs.where("false"), empty, P.path("byte_bpe_50k.json"))
    assert repair.read_ids(spark, empty).count() == 0


@pytest.mark.parametrize("hot", [None, 7, 1 << 53])
def test_one_id_fills_many_ranges(spark, tmp_path, hot):
    rows = [(hot if i % 3 else i, f"text {i} of many") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = str(tmp_path / "ids")
    repair.write_ids(docs, out, P.path("byte_bpe_50k.json"))
    assert spark.read.parquet(out).groupBy("part").agg(F.sum("ids").alias("n")).agg(F.max("n") / F.sum("n")).first()[0] < 0.4
    back = sorted(repair.read_ids(spark, out).collect(), key=lambda r: r["start"])
    key = [TOP if r["doc_id"] is None else r["doc_id"] for r in back]
    assert len(back) == 900 and key == sorted(key)
    assert [r["start"] for r in back] == np.cumsum([0, *[r["n_tokens"] for r in back]])[:-1].tolist()
    crc = lambda t: zlib.crc32(np.array([*repair.library_cache(P.path("byte_bpe_50k.json")).encode([t])[0], 0], "<u4").tobytes())
    assert sorted((str(r["doc_id"]), r["ids_crc32"]) for r in back) == sorted((str(i), crc(t)) for i, t in rows)


def test_one_id_in_many_chunks(spark):
    """op3: rows of one id lie in several chunks, do not remove from each other, and lose to smaller ids."""
    words = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    shared = words("s", 20)
    rows = [(5, f"{words(i, 9)} {shared}") for i in range(40)] + [(None, f"{shared} {words(i, 8)}") for i in range(100, 140)]
    rows += [(2, words("other", 30)), (9, f"{words('other', 30)} end"), (5, words("own", 20)), (5, words("own", 20))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.substring_dedup(docs, chunk_bytes=600, bucket_bytes=900).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["n_removed"] == {5: 0, None: 20, 2: 0, 9: 30}[r["doc_id"]]


def test_slots_of_one_hot_id(spark):
    rows = [(7 if i % 3 else None, f"text {i % 50}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.assign_shards(docs, 4, rows_per_bucket=20).collect()
    assert len(got) == 600 and {r["shard"] for r in got if r["doc_id"] == 7} == {int(sharding.jump_hash(
        np.array([docs.where("doc_id = 7").select(F.xxhash64("doc_id")).first()[0]]).view(np.uint64), 4)[0])}
    for s in range(4):
        own = [r["slot"] for r in got if r["shard"] == s]
        assert sorted(own) == list(range(len(own)))


def test_jump_hash_against_one_key_at_a_time():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 1 << 63, 2000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    for shards in (1, 2, 7, 40, 1000):
        want = []
        for key in keys.tolist():
            at, to = -1, 0
            while to < shards:
                at = to
                key = (key * int(sharding.JUMP_MULTIPLIER) + 1) % (1 << 64)
                to = int((at + 1) * ((1 << 31) / ((key >> 33) + 1)))
            want.append(at)
        assert sharding.jump_hash(keys, shards).tolist() == want
