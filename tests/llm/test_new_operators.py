"""Language ID, cross-tokenizer alignment and conversation repair against brute force on small tables with nulls,
empties, ties, repeated rows and clashing names."""

import hashlib
import math
import re
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pytest

pytest.importorskip("tidemark.llm.registry")
import public_tokenizers as P  # noqa: E402
import regex  # noqa: E402
import sentencepiece  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from tidemark.llm import alignment, conversations, language_id  # noqa: E402

RNG = np.random.default_rng(12)
A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")

# ---------------------------------------------------------------- alignment

TEXTS = ["The quick, brown fox's den; 3.14 (pi)!", "  leading and  double  spaces ", "tab\there\nline\r\nend\r", "été naïve 漢字 🙂 x y",
         "a<s>b</s><unk> <|endoftext|> x", "literal ▁ mark", None, "", " ", "\n", "code() { return x;\r\n}\r", "supercalifragilistic" * 30,
         "The quick, brown fox's den; 3.14 (pi)!", "x \r y　z w", "it's we'll 'quoted'. a.b,c!d?e%f&g$h#i*j|k", "\x00\x1c \x85 q",
         "word " * 3000, "The the THE the. The, the\nthe"]


def _alignments(texts):
    a_tok = Tokenizer.from_file(A_PATH)
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    import json
    letters = {}
    other = 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b:
            letters[chr(b)] = b
        else:
            letters[chr(256 + other)] = b
            other += 1
    vocab = json.load(open(A_PATH, encoding="utf-8"))["model"]["vocab"]
    a_bytes = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else b"" for t, i in vocab.items()}

    def b_bytes(i):
        p = b_tok.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode()

    out = []
    for t in texts:
        a = a_tok.encode(" " + t, add_special_tokens=False).ids if t else []
        b = b_tok.encode(t) if t else []
        whole = (" " + t).encode() if t else b""
        if not t or b"".join(a_bytes[i] for i in a) != whole or b"".join(map(b_bytes, b)) != whole:
            out.append(None)
            continue
        ends = lambda ids, of: np.cumsum([len(of(i)) for i in ids]).tolist()
        ea, eb = ends(a, a_bytes.__getitem__), ends(b, b_bytes)
        cuts = sorted(set(ea) & set(eb))
        groups, lo = [], 0
        for hi in cuts:
            groups.append(([i for i, e in zip(a, ea) if lo < e <= hi], [i for i, e in zip(b, eb) if lo < e <= hi]))
            lo = hi
        links, i, j = [], 0, 0
        while i < len(a) and j < len(b):  # tokens of both sides cover the same bytes
            links.append((a[i], b[j]))
            x, y = ea[i], eb[j]
            i, j = i + (x <= y), j + (y <= x)
        out.append((a, b, groups, links))
    return out


def _expected(texts):
    found = _alignments(texts)
    count = Counter(link for f in found if f for link in f[3])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for f in found:
        if not f:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = f
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(count[k] == best[k[1]] for k in links),
                    sum(count[k] for k in links), hashlib.sha256(said.encode()).hexdigest()))
    return out


def _aligned(df, **how):
    got = {}
    for r in alignment.align(df, A_PATH, B_PATH, **how).collect():
        got.setdefault(r["doc_id"], []).append(tuple(r[c] for c in (*alignment.NUMBERS, "groups_sha256")))
    return got


@pytest.mark.parametrize("how", [{}, {"max_pairs": 20, "cells": 8}, {"fan_in": 2, "pieces": 5}])
def test_alignment(spark, how):
    texts = TEXTS + TEXTS[:3]
    ids = [*range(len(TEXTS)), 0, None, None]
    rows = [(i, t, 1, "x") for i, t in zip(ids, texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, part int, keys string").repartition(5)
    got, want = _aligned(df, **how), {}
    for i, e in zip(ids, _expected(texts)):
        want.setdefault(i, []).append(e)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_alignment_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(df, A_PATH, B_PATH).collect() == []


def test_alignment_of_texts_without_tokens(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "▁")], "doc_id long, text string")
    assert _aligned(df) == {i: [(0, 0, 0, 0, 0, 0, "")] for i in (1, 2, 3)}


@pytest.mark.parametrize("n", [0, 1, 2, 100, 50_000])
def test_perfect_hash(n):
    keys = np.unique(RNG.integers(0, 1 << 48, n))
    of = alignment.PerfectHash.of(keys)
    assert sorted(of.index(keys).tolist()) == list(range(len(keys)))
    assert len(of.bits) * 64 <= 4 * len(keys) + 64 * 32


def test_perfect_hash_with_keys_that_no_level_settles(monkeypatch):
    monkeypatch.setattr(alignment.PerfectHash, "LEVELS", 1)
    keys = np.unique(RNG.integers(0, 1 << 48, 1000))
    of = alignment.PerfectHash.of(keys)
    assert len(of.rest) and sorted(of.index(keys).tolist()) == list(range(len(keys)))


def test_pieces_are_the_whole_text():
    chars = list("ab1é漢.,'!|$ \t\n\r  　{}()_▁")
    for _ in range(3000):
        t = " " + "".join(RNG.choice(chars, RNG.integers(0, 14)))
        assert "".join(alignment.PIECE.findall(t)) == t


def test_alignment_of_random_texts(spark):
    chars = list("ab1éthe.,'!|$  \t\n\r  　{}()_")
    texts = ["".join(RNG.choice(chars, RNG.integers(0, 40))) for _ in range(400)]
    got = _aligned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert [got[i][0] for i in range(len(texts))] == _expected(texts)


# ---------------------------------------------------------------- conversations

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def _least(rows):
    """Cheapest and ASCII-least edits, by trying all of them."""
    @cache
    def go(i, state, room):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        if room:
            for role in ("user", "assistant"):
                if (state, role[0]) in NEXT:
                    c, e, lines = go(i, NEXT[state, role[0]], room - 1)
                    found.append((c + 5, "I" + e, (f"{role}:", *lines)))
        if i < len(rows):
            role, text, fault = rows[i]
            c, e, lines = go(i + 1, state, 2)
            found.append((c + 2, "D" + e, lines))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if (state, role[:1]) in NEXT:
                    c, e, lines = go(i + 1, NEXT[state, role[:1]], 2)
                    found.append((c + more, "K" + e, (f"{role}:{text}", *lines)))
                for to in ("user", "assistant"):
                    if (state, to[0]) in NEXT:
                        c, e, lines = go(i + 1, NEXT[state, to[0]], 2)
                        found.append((c + 1 + more, "R" + e, (f"{to}:{text}", *lines)))
        return min(found, default=(10 ** 9, "", ()))
    return go(0, "", 2)


def _reports(table):
    out, by = {}, {}
    for conv, turn, role, text in table:
        by.setdefault(conv, [])
        name = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = name(role), name(text)
        if kind == 0:
            continue
        role, text = "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        by[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    for conv, rows in by.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in rows:
            bare = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            faults.append(fault)
            seen.add((role, text))
        turns = {r[0] for r in rows} - {None}
        initials = [r[1][:1] for r in rows]
        cost, audit, lines = _least(tuple((r[1], r[2], f) for r, f in zip(rows, faults)))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def _conversations(n=150):
    texts = ["Fine.", "Why?", "cut off", " \n ", "", None, "Fine. ", "No!\t", "été. ü", "a\nb."]
    roles = ["user", "assistant", "system", None, "", "tool", "user", "assistant", "User"]
    table = []
    for c in range(n):
        size = int(RNG.integers(0, 9))
        for turn in range(size):
            turn = [turn, turn, turn, 3, None, turn + 2][int(RNG.integers(0, 6))]
            table.append((c, turn, roles[int(RNG.integers(0, len(roles)))], texts[int(RNG.integers(0, len(texts)))]))
    table += [(None, t, "user" if t % 2 else "assistant", f"Row {t}.") for t in range(6)]
    table += [(900, t, "user", "Same.") for t in range(40)] + [(901, None, "user", "Same.")] * 30
    return table


CONVERSATIONS = _conversations()
SCHEMA = "conv_id long, turn long, role string, text string, kind int, gone string, pos long"


def _repaired(spark, table, **how):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in table], SCHEMA)
    got = conversations.repair_conversations(conversations.damaged(df), **how).collect()
    assert len(got) == len({r["conv_id"] for r in got})
    return {r["conv_id"]: tuple(r[c] for c in (*conversations.COUNTS, "audit", "repaired_sha256")) for r in got}


@pytest.mark.parametrize("how", [{}, {"chunk_bytes": 100}, {"long_rows": 3}, {"long_rows": 0}, {"long_bytes": 25}])
def test_conversations(spark, how):
    assert _repaired(spark, CONVERSATIONS, **how) == _reports(CONVERSATIONS)


def test_a_long_conversation_is_split(spark):
    table = [(7, t, ("user", "assistant", "tool", "system")[int(x)], f"{t % 900} ok" + "." * int(y))
             for t, (x, y) in enumerate(zip(RNG.integers(0, 4, 5000), RNG.integers(0, 3, 5000)))]
    assert _repaired(spark, table, long_rows=1000) == _repaired(spark, table, long_rows=10 ** 9)


def test_conversations_without_rows(spark):
    assert _repaired(spark, []) == {}
    gone = next(c for c in range(10 ** 5) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    want = {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert _repaired(spark, [(gone, 0, "user", "Hi.")] * 3) == want
    assert _repaired(spark, [(gone, 0, "user", "Hi.")] * 3, long_rows=1) == want


# ---------------------------------------------------------------- language ID

VOCAB = {"en": "the and house river with thing water through".split(), "de": "der und haus fluß mit ding wässer durch".split(),
         "fr": "le et maison rivière avec chose eau à".split()}


def _documents(n=300):
    rows = []
    for i in range(n):
        lang = ("en", "de", "fr")[i % 3]
        text = " ".join(RNG.choice(VOCAB[lang], int(RNG.integers(3, 30)))).capitalize() + "."
        rows.append((i, text, None if i % 50 == 7 else lang))
    rows += [(1000, None, "en"), (1001, "", "en"), (1002, "12 34 !? ² ×", "de"), (1003, "漢字", "en"), (1004, "zz qq", None),
             (1005, "waterhouse thingriver", None), (1006, "WÄSSERHAUS durchding", None), (None, "le chose", "xx"), (5, "der der", "de"), (1007, "É À maisons", None)]
    return rows


def _twin(rows, keys):
    """The model and the predictions, one word at a time."""
    words_of = lambda t: regex.findall(r"[\p{L}\p{M}]+", t.lower())
    learnt = {(lang, i, t) for i, t, lang in rows if lang and t is not None and i is not None and zlib.crc32(str(i).encode()) % 5}
    counts = [Counter() for _ in range(6)]
    for lang, _, text in learnt:
        for w in words_of(text):
            counts[0][lang, w] += 1
            for n in range(1, 6):
                padded = f" {w} "
                for k in range(len(padded) - n + 1):
                    g = padded[k:k + n]
                    if g.strip() and (n > 1 or g != " ") and not (g[0] == " " and g[-1] == " "):
                        counts[n][lang, g] += 1
    langs = sorted({x[0] for x in learnt})
    known = [{g for _, g in c} for c in counts]
    assert all(len(k) <= keys for k in known)
    total = [{x: sum(v for (y, _), v in c.items() if y == x) for x in langs} for c in counts]
    share = lambda n, x, g: math.log((counts[n][x, g] + .5) / (total[n][x] + .5 * len(known[n])))
    out = []
    for _, text, _ in rows:
        words = words_of(text or "")
        if not words:
            out.append(("und", 0.0))
            continue
        s = dict.fromkeys(langs, 0.0)
        for w in words:
            padded = f" {w} "
            for n in (0, 5, 4, 3, 2, 1):
                have = [w] if n == 0 else [padded[k:k + n] for k in range(len(padded) - n + 1)]
                have = [g for g in have if g in known[n]]
                if have:
                    for x in langs:
                        s[x] += sum(share(n, x, g) for g in have) / len(have)
                    break
        best = max(langs, key=lambda x: s[x])
        out.append((best, 1 / sum(math.exp(s[x] - s[best]) for x in langs)))
    return out


def test_language_id(spark):
    rows = _documents()
    rows.append(rows[4])
    df = spark.createDataFrame([(*r, 3, "s") for r in rows], "doc_id long, text string, lang string, h int, level string").repartition(4)
    got = {}
    for r in language_id.identify(df).collect():
        got.setdefault(r["doc_id"], []).append((r["lang_pred"], round(r["score"], 9)))
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    want = {}
    for r, (lang, score) in zip(rows, _twin(rows, language_id.KEYS)):
        want.setdefault(r[0], []).append((lang, round(score, 9)))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert got[1002] == [("und", 0.0)] and got[1005][0][0] == "en" and got[1006][0][0] == "de"


def test_language_id_sample_and_keys_are_bounds(spark):
    df = spark.createDataFrame(_documents(), "doc_id long, text string, lang string")
    taken = language_id.training_sample(df, 30).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in taken} == {"en": 10, "de": 10, "fr": 10}
    assert all(len(k) <= 4 for k, _ in language_id.fit(df, 30, 4).levels)


def test_language_id_without_anything_to_learn(spark):
    df = spark.createDataFrame([(1, "word", None), (None, "word", "en"), (2, None, "en")], "doc_id long, text string, lang string")
    assert {(r["lang_pred"], r["score"]) for r in language_id.identify(df).collect()} == {("und", 0.0)}
    assert language_id.identify(df.where("false")).collect() == []


def test_language_id_held_out_accuracy(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    docs = spark.read.parquet(path)
    out = language_id.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    right = out.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert right >= 0.97


# ---------------------------------------------------------------- words of one polynomial's hash

def _thue_morse(letters: str) -> str:
    return "".join(letters[bin(i).count("1") % 2] for i in range(1024))


def test_words_that_share_polynomial_hashes(spark):
    """A Thue-Morse word and its complement are told apart, as single documents and inside a long window."""
    from tidemark.llm import jaccard_join, substring_dedup
    one, two = _thue_morse("ab"), _thue_morse("ba")
    df = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(df).collect()} == {1: 1, 2: 2, 3: 1}
    words = [f"w{i}" for i in range(18)]
    texts = [" ".join([*words[:6], x, *words[6:]]) for x in (one, two, one)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in substring_dedup.substring_dedup(df, 13).collect()} == {0: 0, 1: 0, 2: 19}


def test_long_words_and_pieces_of_hashes():
    from tidemark.llm import textnp
    import pyarrow as pa
    texts = ["x" * 200_000 + " y " + "z" * 70_000, "", None, "y", " y\tz" * 50_000, "z" * 70_000]
    w = textnp.Words(pa.array(texts))
    each = {}
    for i, t in enumerate(texts):
        for k, word in enumerate(re.findall(r"[^\x20\x09-\x0D]+", t or "")):
            h = int(w.hash[w.first[i] + k])
            assert each.setdefault(word, h) == h
    assert len(set(each.values())) == len(each) == 4


def test_carried_text_goes_once(spark):
    from tidemark.llm import substring_dedup
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(1, passage, "a"), (2, f"start  {passage}\tend", "b"), (3, None, "c"), (4, "kept  as is", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in substring_dedup.substring_dedup(df, 13, carry=["text", "lang"]).collect()}
    assert {i: (r["text"], r["lang"]) for i, r in got.items()} == {i: (t, x) for i, t, x in rows}
    assert got[2]["kept"] == "start end" and got[4]["kept"] == "kept as is"


def test_listed_hosts_are_lowered_as_the_urls_are(spark):
    from tidemark.llm import url_filter
    pages = spark.createDataFrame([(1, "http://Éx.COM/a"), (2, "http://éx.com/")], "page_id long, url string")
    listed = spark.createDataFrame([("Éx.Com",)], "key string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.url_filter(pages, listed).collect()}
    assert got[1] == "block" and got[2] == "allow"
