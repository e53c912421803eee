"""BPE encoding and decoding (operator 2): per-prefix dynamic programming.

For byte-level BPE the last token of the encoding of each prefix is unique. Reading a word byte by byte, a
suffix automaton of the vocabulary (a trie with links to the longest suffix that is also in it) gives all
tokens that end at a place. Of these exactly one is compatible with the last token of the prefix before it:
two neighbours are compatible when merging their bytes by rank would never join across their border. That is
read off their merge trees alone: undo merges from the latest to the earliest on the two sides of the border;
if the two symbols that face each other at some time form a pair of an earlier rank than the merges that next
swallow either, the border would have closed. (At equal ranks the left pair merges first.) Following the stored
last tokens back from the end gives the exact ids. All words of a batch advance together as arrays.

Texts are cut by the tokenizer file's own pre-tokenizer, its added tokens cut out first; the encoding of a
piece of text is kept in a bounded cache. Decoding concatenates token bytes and reads them as UTF-8.

Defined cases: a null text is empty and has no ids. Rows that repeat an id, empty and very long texts give a
row each, and so does a null id; an empty table gives none. Further input columns are ignored. Files with anything but byte-level BPE are refused.
"""

from __future__ import annotations

import json
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ids_and_text, table
from tidemark.llm.pieces import PieceCache, laid_out
from tidemark.llm.registry import register
from tidemark.llm.textnp import blocks

NEVER = np.int64(1) << 40


class _Table:
    """Open addressing over int64 keys, looked up as whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) * 3).bit_length())
        self.key = np.full(1 << self.bits, -1, np.int64)
        self.value = np.zeros(1 << self.bits, np.int64)
        left = np.arange(len(keys))
        at = self._home(keys)
        while len(left):
            free = self.key[at] == -1
            _, first = np.unique(at[free], return_index=True)
            take = np.flatnonzero(free)[first]
            self.key[at[take]] = keys[left[take]]
            self.value[at[take]] = values[left[take]]
            rest = np.ones(len(left), bool)
            rest[take] = False
            left, at = left[rest], (at[rest] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray, default) -> np.ndarray:
        at = self._home(keys)
        out = np.full(len(keys), default, np.int64)
        have = self.key[at]
        hit = have == keys
        out[hit] = self.value[at[hit]]
        open_ = np.flatnonzero(~hit & (have != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            have = self.key[at[open_]]
            hit = have == keys[open_]
            out[open_[hit]] = self.value[at[open_[hit]]]
            open_ = open_[~hit & (have != -1)]
        return out


def _byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 letters stand for themselves, the others for 256, 257, ..."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteBpe:
    """Vocabulary, merge trees and suffix automaton of one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback",
                           "ignore_merges") if model.get(k)]
        added = spec["added_tokens"]
        if (model["type"] != "BPE" or odd or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel"
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added)):
            raise ValueError(f"not plain byte-level BPE: {path}")
        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.added = {t["content"]: t["id"] for t in added}
        self.split_added = re.compile("(" + "|".join(sorted(map(re.escape, self.added), key=len, reverse=True)) + ")") if added else None
        letters = _byte_letters()
        self.to_latin = {ord(c): chr(b) for c, b in letters.items()}
        size = 1 + max([*model["vocab"].values(), *self.added.values()])
        self.bytes: list[bytes] = [b""] * size
        for token, i in model["vocab"].items():
            self.bytes[i] = bytes(letters[c] for c in token)
        for content, i in self.added.items():
            self.bytes[i] = content.encode()
        self.length = np.array([len(b) for b in self.bytes], np.int64)
        self._merges(model)
        self._automaton()
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.at = np.r_[0, np.cumsum(self.length)[:-1]]
        self.cache = PieceCache(self._encode_pieces)
        self.words: dict[bytes, np.ndarray] = {}

    def _merges(self, model) -> None:
        vocab, n = model["vocab"], len(self.bytes)
        self.rank = np.full(n, -1, np.int64)  # -1: a byte
        self.left, self.right = np.arange(n), np.arange(n)
        keys, ranks = {}, []
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            if (x << 32 | y) not in keys:
                keys[x << 32 | y] = len(ranks)
                ranks.append(r)
                if self.rank[z] < 0 and len(a + b) > 1:
                    self.rank[z], self.left[z], self.right[z] = r, x, y
        self.pairs = _Table(np.fromiter(keys, np.int64, len(keys)), np.array(ranks, np.int64))
        made = np.flatnonzero(self.rank >= 0)
        good = self.length == 1
        whole = self.compatible(self.left[made], self.right[made], below_top=True)
        for i, ok in sorted(zip(made.tolist(), whole.tolist()), key=lambda p: self.rank[p[0]]):
            good[i] = ok and good[self.left[i]] and good[self.right[i]]
        good[list(self.added.values())] = False
        self.good = good  # tokens that their own bytes encode to

    def compatible(self, a: np.ndarray, b: np.ndarray, below_top: bool = False) -> np.ndarray:
        """Whether tokens ``a`` and ``b`` may stand side by side; ``below_top``: leave out the pair (a, b) itself."""
        ok = np.ones(len(a), bool)
        live, a, b = np.arange(len(a)), a.copy(), b.copy()
        next_a, next_b = np.full(len(a), NEVER), np.full(len(a), NEVER)  # rank that swallows a, b
        first = below_top
        while len(live):
            if not first:
                q = self.pairs.get(a << 32 | b, NEVER)
                closes = (q < next_a) & (q <= next_b) & (q < NEVER)
                ok[live[closes]] = False
            else:
                closes = np.zeros(len(live), bool)
            first = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~closes & ((ra >= 0) | (rb >= 0))
            live, a, b, next_a, next_b, ra, rb = (v[go] for v in (live, a, b, next_a, next_b, ra, rb))
            undo = ra > rb
            next_a, next_b = np.where(undo, ra, next_a), np.where(undo, next_b, rb)
            a, b = np.where(undo, self.right[a], a), np.where(undo, b, self.left[b])
        return ok

    def _automaton(self) -> None:
        child: dict[int, int] = {}
        ends, depth = [-1], [0]
        for i in np.flatnonzero(self.good).tolist():
            at = 0
            for byte in self.bytes[i]:
                to = child.get(at << 8 | byte)
                if to is None:
                    to = child[at << 8 | byte] = len(ends)
                    ends.append(-1)
                    depth.append(depth[at] + 1)
                at = to
            ends[at] = i
        n = len(ends)
        link, shorter = [0] * n, [-1] * n  # longest proper suffix in the trie; longest token that is a proper suffix
        for key, to in sorted(child.items(), key=lambda kv: depth[kv[1]]):
            at, byte = key >> 8, key & 255
            if at:
                s = link[at]
                while s and (s << 8 | byte) not in child:
                    s = link[s]
                link[to] = child.get(s << 8 | byte, 0)
            s = link[to]
            shorter[to] = ends[s] if ends[s] >= 0 else shorter[s]
        self.child = _Table(np.fromiter(child, np.int64, len(child)), np.fromiter(child.values(), np.int64, len(child)))
        self.link = np.array(link)
        ends, shorter = np.array(ends), np.array(shorter)
        self.longest = np.where(ends >= 0, ends, shorter)  # of a state: longest token that ends here
        self.next = np.full(len(self.bytes), -1, np.int64)  # of a token: next shorter token that is its suffix
        have = np.flatnonzero(ends >= 0)
        self.next[ends[have]] = shorter[have]

    def _step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        out = self.child.get(state << 8 | byte, -1)
        while True:
            miss = np.flatnonzero((out < 0) & (state > 0))
            if not len(miss):
                return np.maximum(out, 0)
            state[miss] = self.link[state[miss]]
            out[miss] = self.child.get(state[miss] << 8 | byte[miss], -1)

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word (bytes between two cuts of the pre-tokenizer)."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
        size = np.array([len(w) for w in words], np.int64)
        order = np.argsort(size, kind="stable")
        order = order[size[order] > 0]
        lo = 0
        while lo < len(order):  # words of like length, in matrices of bounded size
            top = max(8, 2 * int(size[order[lo]]))
            hi = min(int(np.searchsorted(size[order], top, "right")), lo + max(1, (1 << 22) // top))
            part = order[lo:hi]
            for i, ids in zip(part.tolist(), self._matrix([words[i] for i in part], size[part])):
                out[i] = ids
            lo = hi
        return out

    def _matrix(self, words: list[bytes], size: np.ndarray) -> list[np.ndarray]:
        n, longest = len(words), int(size[-1])  # ascending sizes
        text = np.zeros((n, longest), np.uint8)
        text[np.arange(longest) < size[:, None]] = np.frombuffer(b"".join(words), np.uint8)
        last = np.full((n, longest + 1), -1, np.int32)
        state = np.zeros(n, np.int64)
        for j in range(1, longest + 1):
            rows = np.arange(int(np.searchsorted(size, j)), n)
            state[rows] = self._step(state[rows], text[rows, j - 1].astype(np.int64))
            token = self.longest[state[rows]]
            while len(rows):
                start = j - self.length[token]
                fits = start == 0
                inner = np.flatnonzero(~fits)
                fits[inner] = self.compatible(last[rows[inner], start[inner]].astype(np.int64), token[inner])
                last[rows[fits], j] = token[fits]
                rows, token = rows[~fits], self.next[token[~fits]]
        back, row, at = [], np.arange(n), size.copy()
        while len(row):
            token = last[row, at[row]]
            back.append((row, token))
            at[row] -= self.length[token]
            row = row[at[row] > 0]
        rows, tokens = np.concatenate([r for r, _ in back])[::-1], np.concatenate([t for _, t in back])[::-1]
        order = np.argsort(rows, kind="stable")
        return np.split(tokens[order], np.cumsum(np.bincount(rows, minlength=n))[:-1])

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self.words) > 300_000:
            self.words.clear()
        plan: list[list] = []
        for piece in pieces:
            own: list = []
            for part in (self.split_added.split(piece) if self.split_added else [piece]):
                if part in self.added:
                    own.append(self.added[part])
                elif part:
                    own += [w.translate(self.to_latin).encode("latin-1") for w, _ in self.cut(part)]
            plan.append(own)
        new = list({w for own in plan for w in own if isinstance(w, bytes) and w not in self.words})
        self.words.update(zip(new, self.encode_words(new)))
        return laid_out([np.concatenate([self.words[w] if isinstance(w, bytes) else np.array([w]) for w in own]) for own in plan])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Text of each row's ids (all rows' ids end to end)."""
        size = self.length[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        raw = self.flat[np.repeat(self.at[ids] - (ends - size), size) + np.arange(total)].tobytes()
        upto = np.r_[0, ends][np.r_[0, np.cumsum(counts)]].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(upto[:-1], upto[1:])]


_MODELS: dict[str, ByteBpe] = {}


def model(path: str) -> ByteBpe:
    """This worker's model of a tokenizer file."""
    if path not in _MODELS:
        _MODELS[path] = ByteBpe(path)
    return _MODELS[path]


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every whole text. ``path``: a tokenizer file that every executor has."""

    def run(batches):
        for b in blocks(batches):
            ids, counts = model(path).cache.encode(b.column("text").to_pylist())
            off = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(off, pa.array(ids, pa.int32()))],
                                             names=["doc_id", "ids"])

    return ids_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the decoded text."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                b = batch.slice(lo, 500)
                ids = b.column("ids").fill_null([])
                text = model(path).decode(ids.flatten().to_numpy(zero_copy_only=False), np.diff(ids.offsets.to_numpy()))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), ids, pa.array(text, pa.string())],
                                                 names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


@register("op2_prefix_bpe")
def op2_prefix_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    out = bpe_decode(bpe_encode(table(spark, sf_dir, "documents"), path), path)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                      F.sha2("text", 256).alias("decoded_sha256"))
