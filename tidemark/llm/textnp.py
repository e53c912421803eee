"""Words of many texts at once, as numpy arrays over the bytes of an Arrow string column.

A word is a maximal run of bytes outside the contracts' white space (all of it ASCII, so bytes and
characters agree). A word's hash is the sum of 64-bit numbers mixed from each byte and its place, mixed again with
the length; a gram's is a polynomial over its words' hashes modulo 2**64, mixed. (A polynomial over bytes would give long words of
certain patterns one hash, whatever the base.) They depend on the bytes alone, never on a process's hash seed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# fixed values: constants of the published 64-bit SplitMix finaliser
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLDEN = 0x9E3779B97F4A7C15

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PIECE = 1 << 16  # bytes whose numbers are held at a time; a longer word is a piece of its own
_GRAM = 0x9FB21C651E98DF2B
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: a bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def salt(n: int) -> np.uint64:
    """The n-th multiple of the golden ratio modulo 2**64."""
    return np.uint64(GOLDEN * n % (1 << 64))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (kept, grown in steps)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = -(-n // (1 << 18)) << 18
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.empty(size, np.uint64)
            p[0], done = 1, 1
            while done < size:  # p[done:2 done] = p[:done] * b**done
                more = min(done, size - done)
                p[done:done + more] = p[:more] * np.uint64(pow(b, done, 1 << 64))
                done += more
            out.append(p)
        have = _POWERS[base] = (out[0], out[1])
    return have


def _ranges(values: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """sum(values[j] * base**(j - start) for start <= j < end) for every range, modulo 2**64."""
    up, down = _powers(base, max(1, len(values)))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=total[1:])
    return (total[end] - total[start]) * down[np.minimum(start, len(down) - 1)]


def _word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each range of bytes (ascending, apart), by pieces of bounded bytes."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + _PIECE, "right")))
        lo, hi = int(start[i]), int(end[j - 1])
        begins, ends = start[i:j] - lo, end[i:j] - lo
        place = np.zeros(hi - lo, np.int64)
        place[begins] = begins
        place = np.arange(hi - lo) - np.maximum.accumulate(place)
        each = np.zeros(hi - lo + 1, np.uint64)
        each[:-1] = mix((place << 8 | raw[lo:hi]).astype(np.uint64) * np.uint64(GOLDEN) + salt(3))
        bounds = np.empty(2 * (j - i), np.int64)
        bounds[::2], bounds[1::2] = begins, ends
        out[i:j] = mix(np.add.reduceat(each, bounds)[::2] + salt(1) * (ends - begins).astype(np.uint64))
        i = j
    return out


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and each text's offset (one more than texts). Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


class Words:
    """Words of a block of texts: byte ranges, 64-bit hashes, and the text of each."""

    def __init__(self, column, lower: bool = False):
        self.raw, self.offsets = text_bytes(column)
        raw = _LOWER[self.raw] if lower else self.raw
        n, texts = len(raw), len(self.offsets) - 1
        inside = ~SPACE[raw]
        edge = np.zeros(n + 1, bool)  # a text begins or ends here
        edge[self.offsets] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:n]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | edge[1:n]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.counts = np.diff(self.first)
        self.text = np.repeat(np.arange(texts), self.counts)
        self.hash = _word_hashes(raw, self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    def grams(self, n: int, at: np.ndarray | None = None, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Word indexes where ``n`` words of one text begin (of ``at``, default all) and the hashes of those."""
        at = np.arange(max(0, len(self) - n + 1)) if at is None else at[at <= len(self) - n]
        at = at[self.text[at] == self.text[at + n - 1]] if len(at) else at
        value = self.hash if not seed else mix(self.hash + salt(seed))
        return at, mix(_ranges(value, _GRAM, at, at + n) + salt(n))

    def joined(self, keep: np.ndarray) -> pa.Array:
        """Each text's kept words joined by one space."""
        texts = len(self.offsets) - 1
        n = len(self.raw)
        start, end, text = self.start[keep], self.end[keep], self.text[keep]
        inside = np.zeros(n + 1, np.int8)
        inside[start] += 1
        inside[end] -= 1  # ends are distinct, and a start may meet an end only across two texts
        mask = np.cumsum(inside[:n], dtype=np.int8).astype(bool)
        later = np.ones(len(start), bool)  # not the first kept word of its text
        if len(start):
            later[0] = False
            later[1:] = text[1:] == text[:-1]
        out = self.raw.copy()
        gap = start[later] - 1  # the byte before such a word is white space
        out[gap] = 32
        mask[gap] = True
        length = np.zeros(texts, np.int64)
        np.add.at(length, text, end - start + later)
        off = np.zeros(texts + 1, np.int64)
        np.cumsum(length, out=off[1:])
        return pa.LargeStringArray.from_buffers(texts, pa.py_buffer(off), pa.py_buffer(out[mask].tobytes()))


def blocks(batches, text: str = "text", limit: int = (2 << 20) - (1 << 18)):
    """Each record batch cut into pieces of about ``limit`` text bytes (one text at least). At the end the
    memory that Arrow keeps for later goes back to the system, as the worker may stay idle beside others."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = text_bytes(batch.column(batch.schema.get_field_index(text)))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi
        del batch, off
    pa.default_memory_pool().release_unused()


def shingle_sets(column, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``n``-word shingles (A-Z lower-cased) of each text, ascending, end to end, and each
    text's offset. A text of fewer words has its whole sequence as one shingle, one without words none."""
    words = Words(column, lower=True)
    at, value = words.grams(n)
    text = words.text[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < n))
    if len(short):
        # the sequence's hash also holds its length, so it never meets a shingle of n words
        at = words.first[short]
        whole = np.zeros(len(short), np.uint64)
        for k in range(1, n):
            of = words.counts[short] == k
            whole[of] = words.grams(k, at[of])[1]
        text, value = np.concatenate([text, short]), np.concatenate([value, whole])
        order = np.argsort(text, kind="stable")
        text, value = text[order], value[order]
    texts = len(words.offsets) - 1
    cut = np.searchsorted(text, np.arange(texts + 1))
    for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
        if hi - lo > 1:
            value[lo:hi].sort()
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    return value[new], np.searchsorted(text[new], np.arange(texts + 1))
