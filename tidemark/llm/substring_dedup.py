"""Substring dedup (operator 3) by recompression.

Rounds rename each text's words. In a round every symbol is left or right by a bit of its name, and a
left symbol followed by a right one becomes one symbol named by the hash of the two; equal names get equal
decisions in every text, so names are global without a dictionary, and all of one window of words agree on
their interior symbols wherever the window stands. (Neighbours in a run of one symbol are both left or both
right, so a run keeps a boundary at each of its symbols and needs no name of its own.) After ``h`` rounds a
symbol has at most 2**h words, the decisions near a window's ends reach at most 2**h - 1 words inside, and
every window of ``k`` words has a common boundary among the 2**h places after that, followed inside the
window by ``g = k - 2**(h+1) + 2`` words. The symbols over those words are named together; a name that two
texts share reveals where they may repeat, and only windows around shared names are verified, by 80 bits
of all their words beside their bucket.

Spark does the exchange: texts are dealt to chunks of bounded size; each chunk sends every name once, with
a mark if two of its documents have it, packed by name bucket; a bucket tells the chunks which names two
documents share; the chunks send their windows around those in the same way, each once with its smallest
document, and learn which occurrences go. So a passage in a third of all documents costs one entry a chunk.
The chunks' exchange of texts is one and is read three times. Chunk and bucket counts grow with the corpus's
bytes, so a bucket's share of names and windows stays the same, and with it the bytes each needs to be told
apart.

Rule: remove each word covered by a window of ``k`` words that also starts in a document with a smaller
doc_id, judged on the input. Defined cases: null text has no words; a text of fewer than ``k`` words keeps
all; rows that repeat a doc_id do not remove from each other; a null doc_id counts as larger than any (and as
equal to 2**63 - 1). Texts are dealt whole, so the longest one must fit a task. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import table
from tidemark.llm.registry import register
from tidemark.llm.textnp import Words, mix, salt

CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 32 << 20
LAST = (1 << 63) - 1
LOW = np.uint64(24)  # the low bits of a hash choose its bucket, the high ones travel
NAMES = "bucket int, chunk int, keys binary, several int"
WINDOWS = "bucket int, chunk int, keys binary, docs binary, runs binary, several binary"
SHARED = "chunk int, bucket int, keys binary"
GONE = "chunk int, every binary, later binary"


def rounds_for(k: int) -> tuple[int, int]:
    """Rounds h and named words g for windows of k words."""
    h = 0
    while k - 2 ** (h + 2) + 2 >= 2 ** (h + 1):
        h += 1
    return h, k - 2 ** (h + 1) + 2


def boundaries(words: Words, h: int) -> np.ndarray:
    """Word indexes where a symbol of round ``h`` begins."""
    name, at, text = words.hash, np.arange(len(words)), words.text
    for r in range(h):
        right = (mix(name + salt(r + 1)) >> np.uint64(63)).astype(bool)
        joins = np.zeros(len(name), bool)
        if len(name):
            joins[:-1] = ~right[:-1] & right[1:] & (text[:-1] == text[1:])
        pair = np.flatnonzero(joins)
        name = name.copy()
        name[pair] = mix(name[pair] * salt(1) + name[pair + 1])
        keep = np.ones(len(name), bool)
        keep[pair + 1] = False
        name, at, text = name[keep], at[keep], text[keep]
    return at


def _table(rows: list[tuple], ddl: str) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in ddl.split(", ")])
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(schema.types)], schema=schema)


def _narrow(key: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bytes of each number, as rows of bytes."""
    return key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]


def _wide(raw: bytes | np.ndarray, width: int) -> np.ndarray:
    have = np.frombuffer(raw, np.uint8).reshape(-1, width) if isinstance(raw, bytes) else raw
    out = np.zeros((len(have), 8), np.uint8)
    out[:, :width] = have
    return out.view("<u8").reshape(-1)


def _bucket(value: np.ndarray, buckets: int) -> np.ndarray:
    return ((value & np.uint64((1 << int(LOW)) - 1)) % np.uint64(buckets)).astype(np.int64)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins in sorted columns."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _both(at: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest document of each run, and whether the run has another."""
    if not len(at):
        return doc[:0], np.zeros(0, bool)
    least = np.minimum.reduceat(doc, at)
    return least, np.maximum.reduceat(doc, at) != least


def pack_names(chunk: int, name: np.ndarray, doc: np.ndarray, buckets: int) -> pa.Table:
    """Each of a chunk's names once, by bucket, those that two of its documents have first: 5 bytes a name.
    (What the bucket and 40 bits cannot tell apart is told apart by the windows.)"""
    order = np.argsort(name)
    name, doc = name[order], doc[order]
    at = _starts(name)
    name, several = name[at], _both(at, doc)[1]
    bucket = _bucket(name, buckets)
    order = np.lexsort((~several, bucket))
    name, several, bucket = name[order], several[order], bucket[order]
    keys, cut = _narrow(name >> LOW, 5), np.searchsorted(bucket, np.arange(buckets + 1))
    return _table([(b, chunk, keys[lo:hi].tobytes(), int(several[lo:hi].sum()))
                   for b, (lo, hi) in enumerate(zip(cut[:-1], cut[1:])) if lo < hi], NAMES)


def shared_names(blobs: pa.Table) -> pa.Table:
    """For one bucket: to each chunk those of its names that two documents or two chunks have. (Rows of one id may
    lie in several chunks; their windows are then looked at and told apart by their ids.)"""
    keys = [_wide(k, 5) for k in blobs["keys"].to_pylist()]
    if not keys:
        return _table([], SHARED)
    size = np.array([len(k) for k in keys])
    own = np.concatenate(keys)
    several = np.concatenate([np.arange(len(k)) < n for k, n in zip(keys, blobs["several"].to_pylist())])
    every = np.sort(own)
    shared = np.unique(np.concatenate([every[1:][every[1:] == every[:-1]], own[several]]))
    if not len(shared):
        return _table([], SHARED)
    hit = shared[np.minimum(np.searchsorted(shared, own), len(shared) - 1)] == own
    cut = np.r_[0, np.cumsum(size)]
    bucket = blobs["bucket"][0].as_py()
    return _table([(c, bucket, _narrow(own[lo:hi][hit[lo:hi]], 5).tobytes())
                   for c, lo, hi in zip(blobs["chunk"].to_pylist(), cut[:-1], cut[1:]) if hit[lo:hi].any()], SHARED)


def pack_windows(chunk: int, key: np.ndarray, doc: np.ndarray, buckets: int) -> pa.Table:
    """Each of a chunk's windows once with its smallest document and whether it has another; 10 bytes a window
    beside its bucket."""
    one, two = key[:, 0], key[:, 1] >> np.uint64(48)
    bucket = _bucket(key[:, 1], buckets)
    order = np.lexsort((two, one, bucket))
    one, two, bucket, doc = one[order], two[order], bucket[order], doc[order]
    at = _starts(one, two, bucket)
    least, several = _both(at, doc)
    one, two, bucket = one[at], two[at], bucket[at]
    order = np.lexsort((least, bucket))
    one, two, bucket, least, several = one[order], two[order], bucket[order], least[order], several[order]
    keys = np.concatenate([_narrow(one, 8), _narrow(two, 2)], 1)
    cut, rows = np.searchsorted(bucket, np.arange(buckets + 1)), []
    for b, (lo, hi) in enumerate(zip(cut[:-1], cut[1:])):
        if lo < hi:
            ids, runs = np.unique(least[lo:hi], return_counts=True)
            rows.append((b, chunk, keys[lo:hi].tobytes(), ids.tobytes(), runs.astype(np.int32).tobytes(),
                         np.packbits(several[lo:hi]).tobytes()))
    return _table(rows, WINDOWS)


def _windows_of(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    have = np.frombuffer(raw, np.uint8).reshape(-1, 10)
    return _wide(have[:, :8], 8), _wide(have[:, 8:], 2)


def covered(blobs: pa.Table) -> pa.Table:
    """For one bucket: to each chunk the windows that a smaller document elsewhere has (``every`` occurrence
    goes) and else those that several of its own documents have (the ``later`` ones go)."""
    one, two, doc, chunk, several = [], [], [], [], []
    for c, k, d, r, s in zip(*(blobs[x].to_pylist() for x in ("chunk", "keys", "docs", "runs", "several"))):
        a, b = _windows_of(k)
        one.append(a), two.append(b), chunk.append(np.full(len(a), c, np.int32))
        doc.append(np.repeat(np.frombuffer(d, np.int64), np.frombuffer(r, np.int32)))
        several.append(np.unpackbits(np.frombuffer(s, np.uint8), count=len(a)).astype(bool))
    if not one:
        return _table([], GONE)
    one, two, doc, chunk, several = map(np.concatenate, (one, two, doc, chunk, several))
    order = np.lexsort((two, one))
    one, two, doc, chunk, several = one[order], two[order], doc[order], chunk[order], several[order]
    at = _starts(one, two)
    least = np.repeat(np.minimum.reduceat(doc, at), np.diff(np.r_[at, len(doc)]))
    every = doc > least
    some = every | several
    order = np.flatnonzero(some)[np.argsort(chunk[some], kind="stable")]
    keys = np.concatenate([_narrow(one[order], 8), _narrow(two[order], 2)], 1)
    chunk, every = chunk[order], every[order]
    at = _starts(chunk)
    return _table([(int(chunk[lo]), keys[lo:hi][every[lo:hi]].tobytes(), keys[lo:hi][~every[lo:hi]].tobytes())
                   for lo, hi in zip(at, [*at[1:], len(chunk)])], GONE)


def _find(one: np.ndarray, two: np.ndarray, wanted_one: np.ndarray, wanted_two: np.ndarray) -> np.ndarray:
    """Row of each wanted pair in the sorted pairs, -1 if absent."""
    out = np.full(len(wanted_one), -1)
    if not len(one):
        return out
    at = np.searchsorted(one, wanted_one)
    for step in range(int(np.diff(np.r_[_starts(one), len(one)]).max())):
        i = np.minimum(at + step, len(one) - 1)
        same = (one[i] == wanted_one) & (two[i] == wanted_two)
        out[same] = i[same]
    return out


class _Chunk:
    """One chunk's texts with the places that the rounds name."""

    def __init__(self, docs: pa.Table, k: int):
        self.k = k
        self.h, self.g = rounds_for(k)
        self.ids = docs["doc_id"].combine_chunks().fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)
        self.words = Words(docs["text"])
        self.doc = self.ids[self.words.text]

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Places that the rounds name, and the names."""
        return self.words.grams(self.g, boundaries(self.words, self.h), seed=1)

    def windows(self, back: pa.Table, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and 128-bit names of the windows that hold a shared name where the rounds promise one."""
        n, reach = len(self.words), 2 ** self.h - 1
        place, name = self.names()
        full = lambda bucket, key: (bucket.astype(np.uint64) << np.uint64(40)) | key
        shared = [full(np.full(len(k) // 5, b), _wide(k, 5)) for b, k in zip(back["bucket"].to_pylist(), back["keys"].to_pylist())]
        shared = np.concatenate(shared) if shared else np.zeros(0, np.uint64)
        hit = place[np.isin(full(_bucket(name, buckets), name >> LOW), shared)]
        near = np.zeros(n + 1, np.int32)
        np.add.at(near, np.maximum(hit - 2 * reach, 0), 1)
        np.add.at(near, np.maximum(hit - reach + 1, 0), -1)
        at, one = self.words.grams(self.k, np.flatnonzero(np.cumsum(near[:n]) > 0), seed=2)
        return at, np.stack([one, self.words.grams(self.k, at, seed=3)[1]], 1)


def released(table_: pa.Table) -> pa.Table:
    """``table_``; what Arrow holds back of earlier groups goes back to the system."""
    pa.default_memory_pool().release_unused()
    return table_


def substring_dedup(docs: DataFrame, k: int = 13, id_col: str = "doc_id", text_col: str = "text",
                    carry: list[str] | None = None, chunk_bytes: int = CHUNK_BYTES,
                    bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the kept words joined by one space), then the columns of ``carry``."""
    if k < 2:
        raise ValueError("windows have two words at least")
    carry = carry or []
    text = F.col(text_col).cast("string")
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks, buckets = 1 + total // chunk_bytes, 1 + total // bucket_bytes
    extra = ["text" if c == text_col else f"c{i}" for i, c in enumerate(carry)]  # the text goes once
    # by id and text, so that one id with very many rows is many chunks
    dealt = docs.select(F.pmod(F.xxhash64(F.col(id_col).cast("long"), text), F.lit(chunks)).cast("int").alias("chunk"),
                        F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                        *[F.col(c).alias(e) for c, e in zip(carry, extra) if e != "text"])

    def names(part: pa.Table) -> pa.Table:
        c = _Chunk(part, k)
        place, name = c.names()
        return released(pack_names(part["chunk"][0].as_py(), name, c.doc[place], buckets))

    def windows(part: pa.Table, back: pa.Table) -> pa.Table:
        c = _Chunk(part, k)
        at, key = c.windows(back, buckets)
        return released(pack_windows(part["chunk"][0].as_py(), key, c.doc[at], buckets))

    def remove(part: pa.Table, back: pa.Table) -> pa.Table:
        c = _Chunk(part, k)
        n = len(c.words)
        gone = np.zeros(n + 1, np.int32)
        told = [(*_windows_of(r), e) for col, e in (("every", True), ("later", False)) for r in back[col].to_pylist()]
        if told:
            one, two = np.concatenate([t[0] for t in told]), np.concatenate([t[1] for t in told])
            every = np.concatenate([np.full(len(t[0]), t[2]) for t in told])
            order = np.lexsort((two, one))
            one, two, every = one[order], two[order], every[order]
            at, first = c.words.grams(k, seed=2)
            at = at[np.isin(first, one)]
            row = _find(one, two, c.words.grams(k, at, seed=2)[1], c.words.grams(k, at, seed=3)[1] >> np.uint64(48))
            at, row = at[row >= 0], row[row >= 0]
            least = np.full(len(one), LAST)
            np.minimum.at(least, row, c.doc[at])
            at = at[every[row] | (c.doc[at] > least[row])]
            np.add.at(gone, at, 1)
            np.add.at(gone, at + k, -1)
        keep = np.cumsum(gone[:n]) == 0
        removed = np.bincount(c.words.text[~keep], minlength=len(c.ids))
        return released(pa.table({"doc_id": part["doc_id"], "n_words": c.words.counts.astype(np.int64),
                                  "n_removed": removed.astype(np.int64), "kept": c.words.joined(keep).cast(pa.string()),
                                  **{e: part[e] for e in extra}}))

    out = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                        T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()),
                        *[T.StructField(e, dealt.schema[e].dataType) for e in extra]])
    nothing = pa.table([pa.array([], t) for t in to_arrow_schema(out).types], names=out.names)
    by_chunk = dealt.groupBy("chunk")
    shared = by_chunk.applyInArrow(names, NAMES).groupBy("bucket").applyInArrow(shared_names, SHARED)
    least = (by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(windows, WINDOWS)
             .groupBy("bucket").applyInArrow(covered, GONE))
    done = by_chunk.cogroup(least.groupBy("chunk")).applyInArrow(
        lambda part, back: remove(part, back) if part.num_rows else nothing, out)
    return done.select("doc_id", "n_words", "n_removed", "kept", *[F.col(e).alias(c) for c, e in zip(carry, extra)])


@register("op3_recompression", r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(words) - 11)) AS i, words FROM w),
s AS (SELECT doc_id, i, list_aggregate(words[i:i + 12], 'string_agg', ' ') AS t FROM g),
b AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY t) AS m FROM s) WHERE m < doc_id),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM b),
e AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS p, unnest(words) AS x FROM w),
k AS (SELECT e.doc_id, string_agg(x, ' ' ORDER BY p) AS kept, count(*) AS n FROM e ANTI JOIN c ON e.doc_id = c.doc_id AND e.p = c.p GROUP BY e.doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id""")
def op3_recompression(spark, sf_dir):
    out = substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
