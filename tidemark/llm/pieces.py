"""Token ids of whole texts through a bounded cache of their pieces.

A piece is a run of white space with the run of other characters after it, cut once more where plain letters or
digits end before plain punctuation. Between a character that is no white space and one that is, and between
such a letter and such a mark, no pre-tokenizer used here has a token and no normaliser joins characters, so a
text's ids are its pieces' ids end to end, and a piece is tokenized once however often it occurs in a task. The
cache is emptied when it holds ``limit`` pieces, so memory does not grow with the input.
"""

from __future__ import annotations

import re

import numpy as np

# fixed values: Unicode's White_Space characters
_WHITE = "\t-\r \x85\xa0  -     　"
_PLAIN = "0-9A-Za-zÀ-ÖØ-öø-ÿ"  # letters and digits of Latin-1
PIECE = re.compile(f"[{_WHITE}]*(?:[{_PLAIN}]+(?=[.,;:!?%&$#*|{_WHITE}]|\\Z)|[^{_WHITE}]+)|[{_WHITE}]+")


class _Codes(dict):
    """Number of each piece; a new piece gets the next number and waits to be tokenized."""

    def __init__(self):
        self.waiting: list[str] = []

    def __missing__(self, piece):
        self.waiting.append(piece)
        n = self[piece] = len(self)
        return n


class PieceCache:
    """``encode_new``: ids of a list of pieces as (all ids, where each piece's begin, how many each has)."""

    def __init__(self, encode_new, limit: int = 400_000):
        self.encode_new, self.limit = encode_new, limit
        self._clear()

    def _clear(self) -> None:
        self.codes = _Codes()
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.start, self.length = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _learn(self) -> None:
        new, self.codes.waiting = self.codes.waiting, []
        if not new:
            return
        ids, start, size = self.encode_new(new)
        first, end = len(self.codes) - len(new), self.used + len(ids)
        while end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.codes) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        self.flat[self.used:end] = ids
        self.length[first:first + len(new)] = size
        self.start[first:first + len(new)] = self.used + start
        self.used = end

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and each text's number of ids."""
        if len(self.codes) > self.limit:
            self._clear()
        number = self.codes.__getitem__
        found = [np.fromiter(map(number, own), np.int64, len(own)) for own in map(PIECE.findall, texts)]
        self._learn()
        code = np.concatenate(found) if found else np.zeros(0, np.int64)
        length = self.length[code]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.start[code] - (ends - length), length) + np.arange(total)]
        cut = np.r_[0, np.cumsum([len(f) for f in found])].astype(np.int64)
        upto = np.r_[0, ends]
        return ids, upto[cut[1:]] - upto[cut[:-1]]


def laid_out(ids: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists of ids end to end, their beginnings and lengths."""
    size = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.concatenate([np.asarray(i, np.int32) for i in ids]) if ids else np.zeros(0, np.int32)
    return flat, np.cumsum(size) - size, size


_WORD = re.compile(" [A-Za-zÀ-ÖØ-öø-ÿ]+")  # one space and one word: one pre-token
_TOGETHER = 256
_CACHES: dict[str, PieceCache] = {}


def _library(path: str):
    """Encoder of new pieces by the tokenizers library. Pieces that are one word each go as texts of many: a
    word's tokens are told by the mark that the vocabulary puts on its first (the space) or last (word end)."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    vocab = tok.get_vocab()
    by_end = any(t.endswith("</w>") for t in vocab)
    mark = np.zeros(1 + max(vocab.values()), bool)
    mark[[i for t, i in vocab.items() if (t.endswith("</w>") if by_end else t.startswith("Ġ"))]] = True

    def encode(pieces: list[str]):
        alike = np.array([_WORD.fullmatch(p) is not None for p in pieces], bool)
        words = [p for p, a in zip(pieces, alike) if a]
        texts = ["".join(words[i:i + _TOGETHER]) for i in range(0, len(words), _TOGETHER)]
        flat, _, _ = laid_out([e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)])
        at = np.flatnonzero(mark[flat])
        at = np.r_[0, at[:-1] + 1] if by_end and len(at) else at
        if len(at) != len(words):  # a vocabulary that does not mark every word
            return laid_out([e.ids for e in tok.encode_batch_fast(pieces, add_special_tokens=False)])
        other = laid_out([e.ids for e in tok.encode_batch_fast([p for p, a in zip(pieces, alike) if not a], add_special_tokens=False)])
        start, size = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        start[alike], size[alike] = at, np.diff(np.r_[at, len(flat)])
        start[~alike], size[~alike] = other[1] + len(flat), other[2]
        return np.concatenate([flat, other[0]]), start, size

    return encode


def library_cache(path: str, limit: int = 400_000) -> PieceCache:
    """This worker's cache over the tokenizers library's own encoding of a tokenizer file."""
    if path not in _CACHES:
        _CACHES[path] = PieceCache(_library(path))
    _CACHES[path].limit = limit
    return _CACHES[path]
