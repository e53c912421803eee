"""Cross-tokenizer alignment (operator 12): minimal perfect hashing of distinct id pairs.

Space+text is encoded by a byte-level BPE file (A) and text by a sentencepiece model (B, which adds the space).
Two tokens are linked where their byte ranges overlap; places where both tokenizations end a token cut groups.

1. Every task aligns its texts and writes how often it saw each id pair linked.
2. The distinct pairs are dealt to ``CELLS`` cells by hash. Each cell builds a minimal perfect hash of its pairs
   (levels of bits; a pair alone at its place in a level is settled there, the others go to the next) and keeps the
   pairs in hash order, so that a pair that was never counted is told from one that was.
3. The tasks' counts become dense vectors indexed by that hash, ``FAN_IN`` tasks to a vector, and the vectors are
   summed in a tree of the same fan-in.
4. A second pass aligns the texts again and looks the counts up. It holds hashes, pairs and vectors of at most
   ``MAX_PAIRS`` pairs (17 bytes each, sent through the driver); with more distinct pairs it is taken several
   times, each time with some of the cells, and each adds its share to what the last one wrote.

A text is cut into pieces at places that no token of either vocabulary spans, so a piece is aligned once however
often it occurs in a task, and a text's alignment is its pieces' end to end. A vocabulary with a token across such
a place is refused.

Defined cases: null and empty texts, and texts that B's tokens do not give back byte by byte (such as ones with
U+2581), have no tokens: zeros, '' as the groups' hash, and nothing counted. Strings of special tokens are plain
text. Every row gets a row, also with a null or repeated id. Very long texts: a text is held whole, its groups'
string only in parts. An empty table gives no rows. Further input columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ids_and_text, stored, table
from tidemark.llm.pieces import _PLAIN, _WHITE, laid_out
from tidemark.llm.registry import register
from tidemark.llm.textnp import blocks, mix, salt

CELLS = 64
FAN_IN = 64
MAX_PAIRS = 1 << 22
TOGETHER = 256
PIECES = 250_000  # kept by a task at most, beyond that its cache is emptied

# white space before which texts are cut; other white space stays with what stands before it
_CUT = " \t\n"
_OTHER = "\x0b-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECE = re.compile(f"[{_WHITE}]*(?:[{_PLAIN}]+(?=[.,;:!?%&$#*|{_CUT}]|\\Z)|[^{_WHITE}]+(?:[{_OTHER}][{_WHITE}]*(?:[^{_WHITE}]+|\\Z))*)|[{_WHITE}]+")

WORD = re.compile(" [A-Za-zÀ-ÖØ-öø-ÿ]+")


class Aligner:
    """Both tokenizers of a worker."""

    def __init__(self, path_a: str, path_b: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        from tidemark.llm.bpe import _byte_letters
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError(f"not plain byte-level BPE: {path_a}")
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        letters = _byte_letters()
        vocab = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (1 + max(self.a.get_vocab().values()))
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else b""
        self.b = SentencePieceProcessor(model_file=path_b)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i)
                        else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        if any(len(PIECE.findall(p.replace("▁", " "))) > 1 for p in names if len(p) > 1) or self.b.encode("a") != [self.b.piece_to_id("▁a")]:
            raise ValueError(f"a piece of this vocabulary goes over a place where texts are cut: {path_b}")
        self.size_a, self.size_b = (np.array(list(map(len, t)), np.int64) for t in (self.bytes_a, self.bytes_b))
        self.first_a, self.first_b = (np.array([t[:1] == b" " for t in of]) for of in (self.bytes_a, self.bytes_b))
        self.flat_a, self.flat_b = (np.frombuffer(b"".join(t), np.uint8) for t in (self.bytes_a, self.bytes_b))
        self.text_a, self.text_b = (list(map(str, range(len(t)))) for t in (self.bytes_a, self.bytes_b))

    def _ids(self, pieces: list[str]) -> tuple:
        """A's ids of all pieces end to end and each one's number of them, and the same of B."""
        a, _, n_a = laid_out([e.ids for e in self.a.encode_batch_fast(pieces, add_special_tokens=False)])
        # B puts a space before every text: in place of the piece's own, or before a letter that is taken off again
        spaced = [p[0] == " " for p in pieces]
        own = self.b.encode([p[1:] if s else "a" + p for p, s in zip(pieces, spaced)], num_threads=1)
        # a lone space: B gives nothing for an empty text
        b, _, n_b = laid_out([(ids or self.b.encode("a ")[1:]) if s else ids[1:] for ids, s in zip(own, spaced)])
        return a, n_a, b, n_b

    def _ids_of_words(self, words: list[str]) -> tuple:
        """The same for pieces of a space and letters, many to a text: a space begins the first token of each."""
        texts = ["".join(words[i:i + TOGETHER]) for i in range(0, len(words), TOGETHER)]
        a, _, _ = laid_out([e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)])
        b, _, _ = laid_out(self.b.encode([t[1:] for t in texts], num_threads=1))
        n_a, n_b = (np.diff(np.r_[np.flatnonzero(first[ids]), len(ids)]) for first, ids in ((self.first_a, a), (self.first_b, b)))
        return (a, n_a, b, n_b) if len(n_a) == len(n_b) == len(words) else self._ids(words)

    @staticmethod
    def _given_back(raw: np.ndarray, length: np.ndarray, ids: np.ndarray, n: np.ndarray, size: np.ndarray, flat: np.ndarray) -> np.ndarray:
        """Whether each piece's tokens (``n`` of ``ids``) have the bytes of the piece (``length`` of ``raw``)."""
        own = size[ids]
        upto = np.r_[0, np.cumsum(own)]
        cut = np.r_[0, np.cumsum(n)]
        same = upto[cut[1:]] - upto[cut[:-1]] == length
        ids, own = (x[np.repeat(same, n)] for x in (ids, own))
        at = (np.cumsum(size) - size)[ids]
        told = flat[np.repeat(at - (np.cumsum(own) - own), own) + np.arange(int(own.sum()))]
        owner = np.repeat(np.arange(len(n)), np.where(same, length, 0))
        same[owner[told != raw[np.repeat(same, length)]]] = False
        return same

    def align(self, pieces: list[str], groups: bool = True) -> dict:
        """For each piece: ok, n_a, n_b, n_groups and its groups' string; all links' piece, A id and B id."""
        alike = np.fromiter((WORD.fullmatch(p) is not None for p in pieces), bool, len(pieces))
        order = np.argsort(~alike, kind="stable")  # words first
        pieces, words = [pieces[i] for i in order.tolist()], int(alike.sum())
        a, n_a, b, n_b = (np.concatenate(x) for x in zip(self._ids_of_words(pieces[:words]), self._ids(pieces[words:])))
        each = [p.encode("utf-8", "surrogatepass") for p in pieces]
        length = np.fromiter(map(len, each), np.int64, len(each))
        raw = np.frombuffer(b"".join(each), np.uint8)
        ok = (self._given_back(raw, length, a, n_a, self.size_a, self.flat_a)
              & self._given_back(raw, length, b, n_b, self.size_b, self.flat_b))
        a, b = a[np.repeat(ok, n_a)], b[np.repeat(ok, n_b)]
        n_a, n_b = np.where(ok, n_a, 0), np.where(ok, n_b, 0)
        ends = np.cumsum(np.where(ok, length, 0))
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        edge = np.union1d(end_a, end_b)  # one link ends at each
        at_a, at_b = np.searchsorted(end_a, edge), np.searchsorted(end_b, edge)
        both = (end_a[at_a] == edge) & (end_b[at_b] == edge)
        piece = np.searchsorted(ends, edge)
        n_groups = np.bincount(piece[both], minlength=len(pieces))
        back = np.argsort(order)  # of a piece as given: its place here
        out = {"ok": ok[back], "n_a": n_a[back], "n_b": n_b[back], "n_groups": n_groups[back],
               "piece": order[piece], "a": a[at_a].astype(np.int64), "b": b[at_b].astype(np.int64)}
        if groups:
            text_a, text_b = ([t[i] for i in ids.tolist()] for t, ids in ((self.text_a, a), (self.text_b, b)))
            to_a, to_b = (at_a[both] + 1).tolist(), (at_b[both] + 1).tolist()
            each = [",".join(text_a[i:j]) + "|" + ",".join(text_b[k:m])
                    for i, j, k, m in zip([0, *to_a], to_a, [0, *to_b], to_b)]
            cut = np.r_[0, np.cumsum(n_groups)].tolist()
            said = [";".join(each[i:j]) for i, j in zip(cut[:-1], cut[1:])]
            out["groups"] = [said[i] for i in back.tolist()]
        return out


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """This worker's aligner of two tokenizer files."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


class _Codes(dict):
    """Numbers of pieces; new ones wait."""

    def __init__(self):
        self.waiting: list[str] = []

    def __missing__(self, piece):
        self.waiting.append(piece)
        n = self[piece] = len(self)
        return n


class _Known:
    """Growing columns of the pieces that a task has aligned."""

    def __init__(self, names: list[str]):
        self.codes = _Codes()
        self.columns = {n: np.zeros(1 << 14, np.int64) for n in names}

    def codes_of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Codes of all texts' pieces end to end, where each text's begin, and the pieces seen first."""
        number = self.codes.__getitem__
        found = [np.fromiter(map(number, own), np.int64, len(own))
                 for own in (PIECE.findall(" " + t) if t else [] for t in texts)]
        new, self.codes.waiting = self.codes.waiting, []
        cut = np.r_[0, np.cumsum([len(f) for f in found])].astype(np.int64)
        return np.concatenate(found) if found else np.zeros(0, np.int64), cut, new

    def learn(self, first: int, values: dict) -> None:
        for name, column in self.columns.items():
            value = values[name]
            while len(column) < first + len(value):
                column = np.concatenate([column, np.zeros_like(column)])
            column[first:first + len(value)] = value
            self.columns[name] = column


def _whole(ok: np.ndarray, code: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Texts with pieces, all of which both tokenizers give back."""
    bad = np.r_[0, np.cumsum(ok[code] == 0)]
    return (cut[1:] > cut[:-1]) & (bad[cut[1:]] == bad[cut[:-1]])


def cell_of(pair: np.ndarray, cells: int) -> np.ndarray:
    return ((mix(pair.astype(np.uint64) + salt(1)) >> np.uint64(32)) % np.uint64(cells)).astype(np.int64)


def summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of each one's numbers."""
    if not len(key):
        return key, n
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[at], np.add.reduceat(n, at)


def pair_counts(docs: DataFrame, path_a: str, path_b: str, cells: int = CELLS, pieces: int = PIECES) -> DataFrame:
    """Each task's counts: part, cell, pairs (A id times 2**32 plus B id) and how often each was linked."""

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()

        def sent(pairs, code_of, seen):
            if not pairs:
                return
            pair, of = np.concatenate(pairs), np.concatenate(code_of)
            times = seen[of]
            pair, n = summed(pair[times > 0], times[times > 0])
            cell = cell_of(pair, cells)
            order = np.argsort(cell, kind="stable")
            off = np.searchsorted(cell[order], np.arange(cells + 1))
            has = np.flatnonzero(np.diff(off))
            if len(has):
                own = pa.array(np.r_[off[has], off[-1]].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(has), part, np.int32)), pa.array(has.astype(np.int32)),
                     pa.ListArray.from_arrays(own, pa.array(pair[order])), pa.ListArray.from_arrays(own, pa.array(n[order]))],
                    names=["part", "cell", "pairs", "counts"])

        known, pairs, code_of, seen = _Known(["ok"]), [], [], np.zeros(1 << 14, np.int64)
        for block in blocks(batches):
            code, cut, new = known.codes_of(block.column("text").to_pylist())
            if new:
                first = len(known.codes) - len(new)
                got = aligner(path_a, path_b).align(new, groups=False)
                known.learn(first, got)
                pairs.append(got["a"] << 32 | got["b"])
                code_of.append(got["piece"] + first)
            whole = _whole(known.columns["ok"], code, cut)
            times = np.bincount(code[np.repeat(whole, np.diff(cut))], minlength=len(seen))
            times[:len(seen)] += seen
            seen = times
            if len(known.codes) > pieces:
                yield from sent(pairs, code_of, np.r_[seen, np.zeros(len(known.codes), np.int64)])
                known, pairs, code_of, seen = _Known(["ok"]), [], [], np.zeros(1 << 14, np.int64)
        yield from sent(pairs, code_of, np.r_[seen, np.zeros(len(known.codes), np.int64)])

    return docs.select("text").mapInArrow(run, "part int, cell int, pairs array<long>, counts array<long>")


class PerfectHash:
    """Minimal perfect hash: levels of bits, and the few keys that no level settled."""

    LEVELS = 32

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, rest: np.ndarray):
        self.bits, self.sizes, self.rest = bits, sizes, rest
        ones = np.bitwise_count(bits).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.settled = int(ones.sum())

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        words, sizes = [], []
        while len(keys) and len(sizes) < cls.LEVELS:
            size = -(-2 * len(keys) // 64)
            place = cls._place(keys, len(sizes), size)
            alone = np.bincount(place, minlength=64 * size)[place] == 1
            level = np.zeros(64 * size, np.uint8)
            level[place[alone]] = 1
            words.append(np.packbits(level, bitorder="little").view("<u8"))
            sizes.append(size)
            keys = keys[~alone]
        return cls(np.concatenate(words) if words else np.zeros(0, np.uint64), np.array(sizes, np.int64), np.sort(keys))

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys.astype(np.uint64) + salt(level + 2)) % np.uint64(64 * size)).astype(np.int64)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key below the number of keys; any place or -1 for a key that was not given."""
        out = np.full(len(keys), -1)
        left, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            place = self._place(keys[left], level, size)
            word, bit = base + place // 64, (place % 64).astype(np.uint64)
            hit = (self.bits[word] >> bit & np.uint64(1)).astype(bool)
            low = self.bits[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[left[hit]] = self.before[word[hit]] + np.bitwise_count(low)
            left, base = left[~hit], base + size
        if len(left) and len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[left]), len(self.rest) - 1)
            out[left] = np.where(self.rest[at] == keys[left], self.settled + at, -1)
        return out


HASH = "cell int, n long, bits binary, sizes array<long>, rest array<long>, keys array<long>"


def _hash_of(row) -> PerfectHash:
    return PerfectHash(np.frombuffer(row["bits"], "<u8"), np.array(row["sizes"], np.int64), np.array(row["rest"], np.int64))


def _row(part: pa.Table, column: str) -> np.ndarray:
    return part[column].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def perfect_hashes(counts: DataFrame) -> DataFrame:
    """One row a cell: its perfect hash and its pairs in hash order."""

    def build(part: pa.Table) -> pa.Table:
        keys = part["pair"].to_numpy().astype(np.int64)
        of = PerfectHash.of(keys)
        ordered = np.zeros(len(keys), np.int64)
        ordered[of.index(keys)] = keys
        longs = pa.list_(pa.int64())
        return pa.table([pa.array([part["cell"][0].as_py()], pa.int32()), pa.array([len(keys)], pa.int64()),
                         pa.array([of.bits.astype("<u8").tobytes()], pa.binary()), pa.array([of.sizes], longs),
                         pa.array([of.rest], longs), pa.array([ordered], longs)],
                        names=["cell", "n", "bits", "sizes", "rest", "keys"])

    return counts.select("cell", F.explode("pairs").alias("pair")).distinct().groupBy("cell").applyInArrow(build, HASH)


def tree_sum(counts: DataFrame, hashes: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """cell and its dense vector of counts, indexed by the cell's hash."""
    counts = counts.withColumn("branch", F.expr(f"part div {fan_in}").cast("long"))
    schema = "cell int, branch long, counts array<long>"

    def vector(part, dense):
        return pa.table([part["cell"].combine_chunks()[:1], part["branch"].combine_chunks()[:1], pa.array([dense], pa.list_(pa.int64()))],
                        names=["cell", "branch", "counts"])

    def dense(part: pa.Table, own: pa.Table) -> pa.Table:
        row = own.to_pylist()[0]
        at = _hash_of(row).index(_row(part, "pairs"))
        out = np.zeros(row["n"], np.int64)
        np.add.at(out, at, _row(part, "counts"))
        return vector(part, out)

    def add(part: pa.Table) -> pa.Table:
        return vector(part, _row(part, "counts").reshape(part.num_rows, -1).sum(0))

    branches = (counts.agg(F.max("branch")).first()[0] or 0) + 1
    of_cell = hashes.select(F.col("cell").alias("of"), "n", "bits", "sizes", "rest")
    at_branch = counts.select(F.col("cell").alias("at"), F.col("branch").alias("for")).distinct().join(of_cell, F.col("at") == F.col("of"))
    out = counts.groupBy("cell", "branch").cogroup(at_branch.groupBy("at", "for")).applyInArrow(dense, schema)
    while branches > 1:
        branches = -(-branches // fan_in)
        out = out.withColumn("branch", F.expr(f"branch div {fan_in}")).groupBy("cell", "branch").applyInArrow(add, schema)
    return out.drop("branch")


class Lookup:
    """Counts of the pairs of some cells, and each B id's highest count."""

    def __init__(self, rows: list, best: np.ndarray, cells: int):
        self.cells, self.best = cells, best
        self.of = {r["cell"]: (_hash_of(r), np.array(r["keys"], np.int64), np.array(r["counts"], np.int64)) for r in rows}

    def counts(self, pair: np.ndarray) -> np.ndarray:
        """Count of each pair, 0 of one that was not counted or lies in another pass's cell."""
        out = np.zeros(len(pair), np.int64)
        cell = cell_of(pair, self.cells)
        order = np.argsort(cell, kind="stable")
        cut = np.searchsorted(cell[order], np.arange(self.cells + 1))
        for c, (hashed, keys, counts) in self.of.items():
            own = order[cut[c]:cut[c + 1]]
            at = hashed.index(pair[own])
            good = (at >= 0) & (keys[np.maximum(at, 0)] == pair[own])
            out[own[good]] = counts[at[good]]
        return out


NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def _second_pass(docs: DataFrame, lookup, path_a: str, path_b: str, texts: bool, pieces: int) -> DataFrame:
    """Counts looked up over another alignment; added to n_best and count_sum of an earlier such pass, if any."""
    again = "n_best" in docs.columns
    schema = "doc_id long, " + "text string, " * texts + "".join(f"{n} long, " for n in NUMBERS) + "groups_sha256 string"

    def run(batches):
        known, strings = _Known(["ok", *NUMBERS]), []
        for block in blocks(batches):
            texts_ = block.column("text").to_pylist()
            code, cut, new = known.codes_of(texts_)
            if new:
                got = aligner(path_a, path_b).align(new)
                n = lookup.value.counts(got["a"] << 32 | got["b"])
                best = (n > 0) & (n == lookup.value.best[got["b"]])
                got |= {"n_links": np.bincount(got["piece"], minlength=len(new)),
                        "n_best": np.bincount(got["piece"], best, len(new)).astype(np.int64)}
                got["count_sum"] = np.zeros(len(new), np.int64)
                np.add.at(got["count_sum"], got["piece"], n)
                known.learn(len(known.codes) - len(new), got)
                strings += got["groups"]
            whole = _whole(known.columns["ok"], code, cut)
            out = {}
            for name in NUMBERS:
                upto = np.r_[0, np.cumsum(known.columns[name][code])]
                out[name] = np.where(whole, upto[cut[1:]] - upto[cut[:-1]], 0)
                if again and name in ("n_best", "count_sum"):
                    out[name] = out[name] + block.column(name).to_numpy(zero_copy_only=False)
            digests = []
            for good, lo, hi in zip(whole.tolist(), cut[:-1].tolist(), cut[1:].tolist()):
                digest = hashlib.sha256()
                for at in range(lo, hi if good else lo, 100_000):
                    digest.update((";" * (at > lo) + ";".join(map(strings.__getitem__, code[at:min(hi, at + 100_000)].tolist()))).encode())
                digests.append(digest.hexdigest() if good else "")
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), *([block.column("text").cast(pa.string())] if texts else []),
                 *[pa.array(out[n], pa.int64()) for n in NUMBERS], pa.array(digests, pa.string())],
                names=["doc_id", *["text"] * texts, *NUMBERS, "groups_sha256"])
            if len(known.codes) > pieces:
                known, strings = _Known(["ok", *NUMBERS]), []

    return docs.mapInArrow(run, schema)


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS,
          fan_in: int = FAN_IN, max_pairs: int = MAX_PAIRS, pieces: int = PIECES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. Paths: files that every executor has."""
    spark = docs.sparkSession
    docs = ids_and_text(docs, id_col, text_col)
    counts = stored(pair_counts(docs, path_a, path_b, cells, pieces), "pair-counts")
    hashes = stored(perfect_hashes(counts), "pair-hashes")
    cells_of = stored(hashes.join(tree_sum(counts, hashes, fan_in), "cell"), "pair-vectors")
    # one number for each id of B's vocabulary, whatever the corpus
    top = (cells_of.select(F.explode(F.arrays_zip("keys", "counts")).alias("x"))
           .groupBy((F.col("x.keys") % (1 << 32)).alias("b")).agg(F.max("x.counts").alias("n")).collect())
    best = np.zeros(1 + max([r["b"] for r in top], default=0), np.int64)
    for r in top:
        best[r["b"]] = r["n"]
    groups, held = [[]], 0
    for cell, n in sorted((r["cell"], r["n"]) for r in hashes.select("cell", "n").collect()):
        if groups[-1] and held + n > max_pairs:
            groups.append([])
            held = 0
        groups[-1].append(cell)
        held += n
    size = 1 << 16  # ids of B without any count are looked up, too
    best = np.r_[best, np.zeros(max(0, size - len(best)), np.int64)]
    for i, own in enumerate(groups):
        last = i == len(groups) - 1
        lookup = spark.sparkContext.broadcast(Lookup(cells_of.where(F.col("cell").isin(own)).collect(), best, cells))
        docs = _second_pass(docs, lookup, path_a, path_b, not last, pieces)
        if not last:
            docs = stored(docs, "aligned")
    return docs


@register("op12_perfect_hash")
def op12_perfect_hash(spark, sf_dir):
    return align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                 public_tokenizers.path("piece_bpe_32k.model"))
